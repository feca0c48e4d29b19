"""Clients of model services for the LLM and Embedding transforms, over HTTP.

A client takes a batch of texts and runs on executors.  Options are those of
the transforms: model_provider, model, api_key, api_path, and for providers of
one's own `custom_config` with headers, a body and the JSON path of the answer,
in which ${model}, ${prompt} and ${input} stand for their values.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from weftline.sources.http import at_path
from weftline.sources.services.core import ServiceError, ask

#: Where providers listen, and the shape they speak: (chat, embeddings).
PROVIDERS = {
    "OPENAI": ("https://api.openai.com/v1/chat/completions", "https://api.openai.com/v1/embeddings"),
    "DOUBAO": ("https://ark.cn-beijing.volces.com/api/v3/chat/completions", "https://ark.cn-beijing.volces.com/api/v3/embeddings"),
    "DEEPSEEK": ("https://api.deepseek.com/chat/completions", None),
    "MICROSOFT": (None, None),
    "KIMIAI": ("https://api.moonshot.cn/v1/chat/completions", None),
    "ZHIPU": ("https://open.bigmodel.cn/api/paas/v4/chat/completions", "https://open.bigmodel.cn/api/paas/v4/embeddings"),
    "QIANFAN": ("https://qianfan.baidubce.com/v2/chat/completions", "https://qianfan.baidubce.com/v2/embeddings"),
}


def _filled(value, names: dict):
    if isinstance(value, dict):
        return {k: _filled(v, names) for k, v in value.items()}
    if isinstance(value, list):
        return [_filled(v, names) for v in value]
    if not isinstance(value, str):
        return value
    for name, put in names.items():
        if value in (f"${{{name}}}", f'"${{{name}}}"'):
            return put
        value = value.replace(f"${{{name}}}", put if isinstance(put, str) else json.dumps(put))
    return value


def _custom(name: str, options: dict) -> Callable:
    config = options["custom_config"]
    headers, body, path = config.get("custom_request_headers") or {}, config.get("custom_request_body") or {}, config["custom_response_parse"]

    def one(prompt: str, value):
        said = ask("POST", options["api_path"], _filled(body, {"model": options.get("model", ""), "prompt": prompt, "input": value}), headers, options)
        found = at_path(said, path)
        return found[0] if len(found) == 1 and name == "LLM" else found

    if name == "LLM":
        return lambda texts: [str(one("", t)) for t in texts]

    def embed(texts):
        found = one("", list(texts))
        return found[0] if len(found) == 1 and found and isinstance(found[0], list) and found[0] and isinstance(found[0][0], list) else found

    return embed


def client(name: str, options: dict) -> Callable:
    """LLM: texts to answers; Embedding: texts to vectors, in order."""
    provider = str(options["model_provider"]).upper()
    if provider == "CUSTOM":
        return _custom(name, options)
    if provider not in PROVIDERS:
        raise ValueError(f"unknown model_provider {provider}; there are {sorted([*PROVIDERS, 'CUSTOM'])}")
    url = options.get("api_path") or PROVIDERS[provider][0 if name == "LLM" else 1]
    if not url:
        raise ValueError(f"{provider} needs api_path")
    headers = {"api-key": options["api_key"]} if provider == "MICROSOFT" else {"Authorization": f"Bearer {options['api_key']}"}
    if options.get("oauth_path"):
        url = url.replace("${oauth_path}", options["oauth_path"])

    def chat(texts):
        out = []
        for t in texts:
            said = ask("POST", url, {"model": options["model"], "messages": [{"role": "user", "content": t}]}, headers, options)
            if "choices" not in said:
                raise ServiceError(json.dumps(said)[:500])
            out.append(said["choices"][0]["message"]["content"])
        return out

    def embed(texts):
        said = ask("POST", url, {"model": options["model"], "input": list(texts)}, headers, options)
        if "data" not in said:
            raise ServiceError(json.dumps(said)[:500])
        return [x["embedding"] for x in sorted(said["data"], key=lambda x: x.get("index", 0))]

    return chat if name == "LLM" else embed
