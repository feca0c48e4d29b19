"""Search engines and vector stores, over their HTTP interfaces."""

from __future__ import annotations

import json
import urllib.parse

from weftline.sources.services.core import ServiceError, Sink, Source, ask, basic, call, filled, key_of, lines, listed, sink, source, web

#: The codes of the vector store's data types.
MILVUS_TYPES = {1: "Bool", 2: "Int8", 3: "Int16", 4: "Int32", 5: "Int64", 10: "Float", 11: "Double", 20: "String", 21: "VarChar", 22: "Array", 23: "JSON", 100: "BinaryVector", 101: "FloatVector", 102: "Float16Vector", 103: "BFloat16Vector", 104: "SparseFloatVector"}


@sink("Elasticsearch", "Easysearch")
def elasticsearch(options: dict, values: dict) -> Sink:
    """The bulk interface; with primary_keys a row's id is its key, so that it replaces or removes the row before."""
    hosts, keys = listed(options["hosts"]), listed(options.get("primary_keys") or [])
    glue, kind = options.get("key_delimiter", "_"), options.get("index_type")

    def send(rows, number):
        out = []
        for r in rows:
            about = {"_index": filled(options["index"], r.fields), **({"_type": kind} if kind else {})}
            if keys:
                about["_id"] = key_of(r.fields, keys, glue)
            if r.gone:
                out.append({"delete": about})
            else:
                out += [{"index": about}, r.fields]
        host = hosts[hash(number) % len(hosts)]
        answer = ask("POST", f"{web(host)}/_bulk", lines(out), {"Content-Type": "application/x-ndjson", **basic(options)}, options)
        if answer.get("errors"):
            bad = [i for x in answer["items"] for i in x.values() if i.get("error") and i.get("status") != 404]
            if bad:
                raise ServiceError(f"{len(bad)} rows were refused, the first with {json.dumps(bad[0])[:500]}")

    return Sink(int(options.get("max_batch_size", 10)), send, keyed=True)


@source("Elasticsearch", "Easysearch")
def from_elasticsearch(options: dict, schema) -> Source:
    """A scroll over each slice of each index; `query` filters in the engine, `source` names the fields."""
    host = web(listed(options["hosts"])[0])
    slices = int(options.get("slices", 4))
    indexes = [x["index"] if isinstance(x, dict) else x for x in options.get("index_list") or [options["index"]]]
    fields = options.get("source") or (schema.names if schema is not None else None)
    keep = options.get("scroll_time", "1m")

    def fetch(part):
        body = {"size": int(options.get("scroll_size", 100)), "query": options.get("query") or {"match_all": {}}, "sort": ["_doc"]}
        if fields:
            body["_source"] = list(fields)
        if slices > 1:
            body["slice"] = {"id": part["slice"], "max": slices}
        page = ask("POST", f"{host}/{urllib.parse.quote(part['index'])}/_search", body, basic(options), options, {"scroll": keep})
        while page["hits"]["hits"]:
            for hit in page["hits"]["hits"]:
                yield {"_id": hit.get("_id"), **hit.get("_source", {})}
            page = ask("POST", f"{host}/_search/scroll", {"scroll": keep, "scroll_id": page["_scroll_id"]}, basic(options), options)
        ask("DELETE", f"{host}/_search/scroll", {"scroll_id": [page["_scroll_id"]]}, basic(options), options)

    return Source([{"index": i, "slice": s} for i in indexes for s in range(slices)], fetch)


def _typesense(options: dict) -> tuple[str, dict]:
    return web(listed(options["hosts"])[0]), {"X-TYPESENSE-API-KEY": str(options.get("api_key") or "")}


@sink("Typesense")
def typesense(options: dict, values: dict) -> Sink:
    host, headers = _typesense(options)
    keys = listed(options.get("primary_keys") or [])
    at = f"{host}/collections/{urllib.parse.quote(options['collection'])}/documents"

    def send(rows, number):
        for r in [r for r in rows if r.gone]:
            call("DELETE", f"{at}/{urllib.parse.quote(key_of(r.fields, keys, options.get('key_delimiter', '_')))}", None, headers, options)
        out = [{**r.fields, **({"id": key_of(r.fields, keys, options.get("key_delimiter", "_"))} if keys else {})} for r in rows if not r.gone]
        if out:
            said = call("POST", f"{at}/import", lines(out), {"Content-Type": "text/plain", **headers}, options, {"action": "upsert" if keys else "create"})
            bad = [x for x in said.decode().splitlines() if x.strip() and not json.loads(x).get("success")]
            if bad:
                raise ServiceError(f"{len(bad)} rows were refused, the first with {bad[0][:500]}")

    return Sink(int(options.get("max_batch_size", 10)), send, keyed=True)


@source("Typesense")
def from_typesense(options: dict, schema) -> Source:
    host, headers = _typesense(options)

    def fetch(part):
        params = {"filter_by": options["query"]} if options.get("query") else {}
        said = call("GET", f"{host}/collections/{urllib.parse.quote(options['collection'])}/documents/export", None, headers, options, params)
        yield from (json.loads(x) for x in said.decode().splitlines() if x.strip())

    return Source([0], fetch)


def _qdrant(options: dict) -> tuple[str, dict]:
    """The HTTP port is the one before that of the binary protocol."""
    port = int(options.get("http_port") or int(options.get("port", 6334)) - 1)
    tls = "https" if options.get("use_tls") else "http"
    return f"{tls}://{options.get('host', 'localhost')}:{port}/collections/{urllib.parse.quote(options['collection_name'])}/points", {"api-key": str(options["api_key"])} if options.get("api_key") else {}


@sink("Qdrant")
def qdrant(options: dict, values: dict) -> Sink:
    """A point a row: the key column (or `id`) is its id, arrays of numbers are its vectors, the rest its payload."""
    at, headers = _qdrant(options)
    keys = listed(options.get("primary_keys") or values.get("primary_key") or [])
    name = next((k for k in keys if k), "id")

    def send(rows, number):
        points = []
        for r in [r for r in rows if not r.gone]:
            vectors = {k: v for k, v in r.fields.items() if isinstance(v, list) and v and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in v)}
            points.append({"id": r.fields[name], "vector": vectors, "payload": {k: v for k, v in r.fields.items() if k not in vectors and k != name}})
        if points:
            ask("PUT", at, {"points": points}, headers, options, {"wait": "true"})
        if gone := [r.fields[name] for r in rows if r.gone]:
            ask("POST", f"{at}/delete", {"points": gone}, headers, options, {"wait": "true"})

    return Sink(int(options.get("batch_size", 64)), send, keyed=True)


@source("Qdrant")
def from_qdrant(options: dict, schema) -> Source:
    at, headers = _qdrant(options)

    def fetch(part):
        offset = None
        while True:
            body = {"limit": int(options.get("batch_size", 64)), "with_payload": True, "with_vector": True, **({"offset": offset} if offset is not None else {})}
            page = ask("POST", f"{at}/scroll", body, headers, options)["result"]
            for p in page["points"]:
                vector = p.get("vector")
                yield {"id": p["id"], **(p.get("payload") or {}), **(vector if isinstance(vector, dict) else {"vector": vector})}
            offset = page.get("next_page_offset")
            if offset is None:
                return

    return Source([0], fetch)


def _milvus(options: dict, path: str, body: dict):
    answer = ask("POST", f"{web(options['url'])}/v2/vectordb/{path}", {"dbName": options.get("database", "default"), **body}, {"Authorization": f"Bearer {options.get('token', '')}"}, options)
    if answer.get("code") not in (0, 200):
        raise ServiceError(f"{path}: {answer.get('message')}")
    return answer.get("data")


def milvus_fields(options: dict) -> list[dict]:
    """The fields that `field_schema` asks for, as the store's HTTP interface writes them."""
    out = []
    for f in options.get("field_schema") or []:
        name = f.get("field_name") or f.get("source_field_name")
        kind = MILVUS_TYPES.get(int(f["data_type"]), f["data_type"]) if str(f.get("data_type", "")).isdigit() else f.get("data_type")
        params = {k: f[o] for o, k in (("dimension", "dim"), ("max_length", "max_length"), ("max_capacity", "max_capacity"), ("enable_analyzer", "enable_analyzer"), ("analyzer_params", "analyzer_params"), ("enable_match", "enable_match")) if o in f}
        one = {"fieldName": name, "dataType": kind, "isPrimary": bool(f.get("is_primary_key", False)), "elementTypeParams": params}
        if f.get("is_partition_key") or name == options.get("partition_key"):
            one["isPartitionKey"] = True
        if "is_nullable" in f:
            one["nullable"] = bool(f["is_nullable"])
        if "element_type" in f:
            one["elementDataType"] = MILVUS_TYPES.get(int(f["element_type"]), f["element_type"]) if str(f["element_type"]).isdigit() else f["element_type"]
        out.append(one)
    return out


@sink("Milvus")
def milvus(options: dict, values: dict) -> Sink:
    """Rows by insert, or by upsert where `enable_upsert` says so; `field_schema` renames and types fields and makes the collection."""
    table = values.get("table_name") or "default"
    name = (options.get("collection_rename") or {}).get(table, options.get("collection", table))
    names = {f.get("source_field_name") or f["field_name"]: f.get("field_name") or f["source_field_name"] for f in options.get("field_schema") or []}
    keys = listed(options.get("primary_keys") or values.get("primary_key") or [])
    fields = milvus_fields(options)
    if fields and options.get("schema_save_mode", "CREATE_SCHEMA_WHEN_NOT_EXIST") != "IGNORE":
        there = _milvus(options, "collections/has", {"collectionName": name})["has"]
        mode = options.get("schema_save_mode", "CREATE_SCHEMA_WHEN_NOT_EXIST")
        if mode == "ERROR_WHEN_SCHEMA_NOT_EXIST" and not there:
            raise ServiceError(f"no collection {name}")
        if there and mode == "RECREATE_SCHEMA":
            _milvus(options, "collections/drop", {"collectionName": name})
            there = False
        if not there:
            index = [{"fieldName": f["fieldName"], "indexName": f["fieldName"], "metricType": "COSINE"} for f in fields if f["dataType"].endswith("FloatVector")] if options.get("create_index", True) else []
            _milvus(options, "collections/create", {"collectionName": name, "schema": {"autoId": bool(options.get("enable_auto_id", False)), "enableDynamicField": bool(options.get("enable_dynamic_field", True)), "fields": fields}, "indexParams": index})

    def send(rows, number):
        data = [{names.get(k, k): v for k, v in r.fields.items()} for r in rows if not r.gone]
        if data:
            _milvus(options, "entities/upsert" if options.get("enable_upsert") else "entities/insert", {"collectionName": name, "data": data})
        if gone := [r.fields[keys[0]] for r in rows if r.gone]:
            _milvus(options, "entities/delete", {"collectionName": name, "filter": f"{names.get(keys[0], keys[0])} in {json.dumps(gone)}"})

    return Sink(int(options.get("batch_size", 1000)), send, keyed=True)


@source("Milvus")
def from_milvus(options: dict, schema) -> Source:
    def fetch(part):
        at, size = 0, int(options.get("batch_size", 1000))
        while True:
            page = _milvus(options, "entities/query", {"collectionName": options["collection"], "filter": "", "limit": size, "offset": at, "outputFields": schema.names if schema is not None else ["*"]})
            yield from page
            if len(page) < size:
                return
            at += size

    return Source([0], fetch)


@source("ChromaDB")
def from_chroma(options: dict, schema) -> Source:
    """A collection's records by pages: id, document, embedding, and the metadata's fields."""
    at = f"{web(options['url'])}/api/v2/tenants/{options.get('tenant', 'default_tenant')}/databases/{options.get('database', 'default_database')}/collections"
    headers = {"X-Chroma-Token": options["token"]} if options.get("token") else {}

    def fetch(part):
        found = ask("GET", f"{at}/{urllib.parse.quote(options['collection'])}", None, headers, options)["id"]
        offset, size = 0, int(options.get("batch_size", 1000))
        while True:
            page = ask("POST", f"{at}/{found}/get", {"limit": size, "offset": offset, "include": ["documents", "embeddings", "metadatas"]}, headers, options)
            for i, one in enumerate(page["ids"]):
                take = lambda name, i=i: (page.get(name) or [None] * (i + 1))[i]  # noqa: B023, E731
                yield {"id": one, "document": take("documents"), "embedding": take("embeddings"), **(take("metadatas") or {})}
            if len(page["ids"]) < size:
                return
            offset += size

    return Source([0], fetch)
