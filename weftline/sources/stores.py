"""Where a file plugin's files lie: the address in Hadoop's terms, with the store's credentials.

Credentials are set for the store's own bucket or host in the session's Hadoop
configuration, so that two stores of one job do not meet.
"""

from __future__ import annotations

import urllib.parse

from pyspark.sql import SparkSession


def _bucket(options: dict) -> str:
    bucket = str(options["bucket"])
    return bucket.split("://", 1)[-1].strip("/")


def settings(plugin: str, options: dict) -> tuple[str, dict[str, str]]:
    """(prefix of a path, Hadoop settings) of a plugin's options."""
    get = lambda *names: next((str(options[n]) for n in names if options.get(n) is not None), None)
    kind = plugin.lower()
    found: dict[str, str | None] = {}
    prefix = ""
    if kind == "s3file" and options.get("bucket"):
        b = _bucket(options)
        prefix, at = f"s3a://{b}", f"fs.s3a.bucket.{b}"
        found = {f"{at}.access.key": get("access_key"), f"{at}.secret.key": get("secret_key", "access_secret"), f"{at}.endpoint": get("fs.s3a.endpoint"), f"{at}.aws.credentials.provider": get("fs.s3a.aws.credentials.provider")}
        found |= {k: str(v) for k, v in (options.get("hadoop_s3_properties") or {}).items()}
    elif kind in ("ossfile", "ossjindofile") and options.get("bucket"):
        prefix = f"oss://{_bucket(options)}"
        found = {"fs.oss.accessKeyId": get("access_key"), "fs.oss.accessKeySecret": get("access_secret"), "fs.oss.endpoint": get("endpoint")}
        if kind == "ossjindofile":
            found |= {"fs.oss.impl": "com.aliyun.jindodata.oss.JindoOssFileSystem"}
    elif kind == "cosfile" and options.get("bucket"):
        prefix = f"cosn://{_bucket(options)}"
        found = {"fs.cosn.userinfo.secretId": get("secret_id"), "fs.cosn.userinfo.secretKey": get("secret_key"), "fs.cosn.bucket.region": get("region"), "fs.cosn.impl": "org.apache.hadoop.fs.CosFileSystem"}
    elif kind == "obsfile" and options.get("bucket"):
        prefix = f"obs://{_bucket(options)}"
        found = {"fs.obs.access.key": get("access_key"), "fs.obs.secret.key": get("access_secret"), "fs.obs.endpoint": get("endpoint"), "fs.obs.impl": "org.apache.hadoop.fs.obs.OBSFileSystem"}
    elif kind == "ftpfile" and options.get("host"):
        host, port = options["host"], int(options.get("port", 21))
        prefix = f"ftp://{host}:{port}"
        found = {f"fs.ftp.user.{host}": get("user"), f"fs.ftp.password.{host}": get("password"), "fs.ftp.host": host, "fs.ftp.host.port": str(port)}
        if str(options.get("connection_mode", "")).lower() == "passive_local":
            found["fs.ftp.data.connection.mode"] = "PASSIVE_LOCAL_DATA_CONNECTION_MODE"
    elif kind == "sftpfile" and options.get("host"):
        host, port = options["host"], int(options.get("port", 22))
        user = urllib.parse.quote(str(options.get("user", "")), safe="")
        prefix = f"sftp://{user + '@' if user else ''}{host}:{port}"
        found = {f"fs.sftp.password.{host}.{options.get('user')}": get("password"), "fs.sftp.impl": "org.apache.hadoop.fs.sftp.SFTPFileSystem"}
    elif kind == "hdfsfile":
        prefix = get("fs.defaultFS") or ""
        found = {"dfs.client.use.datanode.hostname": "true"} if prefix.startswith("hdfs") else {}
        if get("kerberos_principal"):
            found |= {"hadoop.security.authentication": "kerberos", "dfs.namenode.kerberos.principal": get("kerberos_principal")}
    return prefix, {k: v for k, v in found.items() if v is not None}


def located(spark: SparkSession, plugin: str, options: dict) -> str:
    """The address of the plugin's path; sets what reaching it needs."""
    prefix, conf = settings(plugin, options)
    for k, v in conf.items():
        spark._jsc.hadoopConfiguration().set(k, v)
    if options.get("hdfs_site_path"):
        spark._jsc.hadoopConfiguration().addResource(spark._jvm.org.apache.hadoop.fs.Path(options["hdfs_site_path"]))
    if options.get("kerberos_principal") and options.get("kerberos_keytab_path"):
        about = spark._jvm.org.apache.hadoop.security.UserGroupInformation
        about.setConfiguration(spark._jsc.hadoopConfiguration())
        about.loginUserFromKeytab(options["kerberos_principal"], options["kerberos_keytab_path"])
    path = str(options["path"])
    return path if "://" in path or not prefix else f"{prefix.rstrip('/')}/{path.lstrip('/')}"
