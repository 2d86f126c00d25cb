"""Typed options: everything that changes results, with its default."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Options:
    url_whitelist_rx: str | None = None
    url_blacklist_rx: str | None = r"[.](?:jpe?g|pdf|png)$"
    max_url_len: int = 512
    comp_param: bool = True
    download_preference: str = "novelty"
    page_limit: int | None = None
    match_domain: bool = False
    seed_protocols: tuple[str, ...] = ("http",)
    trace_protocols: tuple[str, ...] = ("http", "https")
    mime_whitelist: tuple[str, ...] = ()
    retry_after_default: int | None = None
    healthcheck_interval: int = 100
    healthcheck_tail: int = 100
    healthcheck_threshold: int = 80
    paydirt_rx: str | None = None
    instance: str | None = None
    schema: str | None = None
    volume_threshold: int = 1 << 30
    storage_alternative: str | None = None
    server_mime_type: str | None = None
    server_check_locality: bool = True
    compress_threshold: int = 100
    no_compress_threshold: int = 100_000

    @classmethod
    def from_ini(cls, text: str) -> Options:
        """Options of the [root] section of INI text. Booleans are yes/no words, lists are separated by blanks."""
        parser = configparser.RawConfigParser()
        parser.read_string(text)
        given = dict(parser["root"]) if parser.has_section("root") else {}
        out = {}
        for f in fields(cls):
            if f.name in given:
                kind, raw = str(f.type), given[f.name]
                out[f.name] = parser.getboolean("root", f.name) if kind == "bool" else int(raw) if "int" in kind else tuple(raw.split()) if kind.startswith("tuple") else raw
        return cls(**out)
