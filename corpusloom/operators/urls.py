"""URL operators (URL-1..13): quick rejection, parsing, validation, normal form, fingerprints.

Predicates that prune are built-in expressions; what needs exact percent-coding is one Arrow UDF on
the standard library, which gets a null for every URL that they reject.
"""

from __future__ import annotations

import ipaddress
import posixpath
import re
from urllib.parse import parse_qs, parse_qsl, quote, unquote, urlencode, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: What the quick check rejects, ports, suffixes of several labels, characters left unquoted.
BINARY = "jpg jpeg png gif webp svg ico pdf doc docx xls xlsx ppt pptx zip tar gz rar 7z mp3 mp4 wav avi mov mkv woff woff2 ttf eot css js json xml exe dmg apk".split()
DEFAULT_PORTS = {"http": 80, "https": 443, "ftp": 21, "ftps": 990, "ws": 80, "wss": 443}
SUFFIXES = frozenset("co.uk org.uk ac.uk gov.uk co.jp ne.jp or.jp com.au net.au org.au com.br com.cn com.mx co.in co.nz co.za".split())
MAX_LENGTH = 2048
PATH_SAFE = "/:@!$&'()*+,;=-._~%"
RFC3986 = "^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?"

_host_re = re.compile(r"(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,63}")

PARTS = StructType([StructField(n, IntegerType() if n == "port" else StringType()) for n in "scheme user password host port path query fragment normalized".split()] + [StructField("errors", ArrayType(StringType()))])


def fast_reject(url: Column) -> Column:
    """Too long, no http(s) scheme, or the first dotted suffix before any ? or # is a binary type's."""
    head = F.regexp_extract(url, "^([^?]*)", 1)
    head = F.when(F.contains(url, F.lit("?")), head).otherwise(F.regexp_extract(url, "^([^#]*)", 1))
    suffix = F.lower(F.regexp_extract(head, "(?i)\\.([a-z0-9]{1,5})(?:\\?|#|$)", 1))
    return (F.length(url) > MAX_LENGTH) | ~url.rlike("(?i)^https?://") | suffix.isin(*BINARY)


def remove_dot_segments(path: str) -> str:
    """RFC 3986, 5.2.4."""
    out: list[str] = []
    parts = path.split("/")
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        if part == ".":
            if last:
                out.append("")
        elif part == "..":
            if len(out) > 1 or (out and out[0]):
                out.pop()
            if last:
                out.append("")
        else:
            out.append(part)
    return "/".join(out)


def parse(url: str) -> dict:
    """Parts of a URL; a missing scheme counts as https. Raises ValueError where a port is no number."""
    url = url.strip()
    s = urlsplit(url)
    if not s.netloc and "://" not in url:
        s = urlsplit("//" + url)
    return {"scheme": (s.scheme or "https").lower(), "user": unquote(s.username or ""), "password": unquote(s.password or ""), "host": (s.hostname or "").lower(), "port": s.port, "path": s.path or "/", "query": s.query, "fragment": s.fragment}


def validate(p: dict) -> list[str]:
    """Names of the failed checks, in a fixed order."""
    host = p["host"]

    def is_ip() -> bool:
        try:
            ipaddress.ip_address(host.strip("[]"))
        except ValueError:
            return False
        return True

    rebuilt = f"{p['scheme']}://{host}{'' if p['port'] is None else ':%d' % p['port']}{p['path']}{'?' + p['query'] if p['query'] else ''}"
    parts = [p["scheme"], p["user"], p["password"], host, p["path"], p["query"], p["fragment"]]
    checks = [
        ("scheme", p["scheme"] in ("http", "https")),
        ("host", bool(host) and (host == "localhost" or is_ip() or (len(host) <= 253 and bool(_host_re.fullmatch(host))))),
        ("port", p["port"] is None or 1 <= p["port"] <= 65535),
        ("path", p["path"].startswith("/")),
        ("length", len(rebuilt) <= MAX_LENGTH),
        ("characters", not any(ord(c) < 32 or ord(c) == 127 for x in parts for c in x)),
        ("security", p["scheme"] not in ("javascript", "data", "file", "vbscript")),
    ]
    return [name for name, ok in checks if not ok]


def normalize(p: dict) -> str:
    """Crawler's normal form: no fragment, default port or blank parameter; sorted query; collapsed path."""
    host = p["host"].rstrip(".")
    port = "" if p["port"] in (None, DEFAULT_PORTS.get(p["scheme"]) if p["scheme"] in ("http", "https") else None) else f":{p['port']}"
    path = "/" + posixpath.normpath("/" + p["path"].lstrip("/")).lstrip("/")
    path = quote(path, safe=PATH_SAFE)
    query = urlencode(sorted(parse_qsl(p["query"], keep_blank_values=False)))
    user = quote(p["user"], safe="") + (":" + quote(p["password"], safe="") if p["password"] else "") + "@" if p["user"] else ""
    return f"{p['scheme']}://{user}{host}{port}{path}{'?' + query if query else ''}"


def canonical(p: dict, drop_fragment: bool = False) -> str:
    """RFC 3986 section 6.2 form: query order and fragment kept."""
    tidy = lambda s: quote(unquote(s), safe="/:@!$&'()*+,;=~")
    host = p["host"].rstrip(".")
    host = f"[{host}]" if ":" in host else host
    port = "" if p["port"] in (None, DEFAULT_PORTS.get(p["scheme"])) else f":{p['port']}"
    path = tidy(remove_dot_segments(p["path"])) or "/"
    return f"{p['scheme']}://{host}{port}{path}{'?' + tidy(p['query']) if p['query'] else ''}{'#' + p['fragment'] if p['fragment'] and not drop_fragment else ''}"


def domain_parts(host: str) -> tuple[str, str, str]:
    """(subdomain, domain, suffix); an address or a single label is a domain alone."""
    labels = host.split(".")
    if ":" in host or len(labels) == 1 or all(x.isdigit() for x in labels):
        return "", host, ""
    n = 2 if ".".join(labels[-2:]) in SUFFIXES and len(labels) > 2 else 1
    return ".".join(labels[: -n - 1]), labels[-n - 1], ".".join(labels[-n:])


def query_params(query: str) -> dict[str, list[str]]:
    return parse_qs(query, keep_blank_values=True)


@pandas_udf(PARTS)
def url_parts(url: pd.Series) -> pd.DataFrame:
    """Parts, normal form and failed checks; all null for a null, blank or unparsable URL."""
    names = ["scheme", "user", "password", "host", "port", "path", "query", "fragment"]

    def one(x: str | None) -> list:
        if not x or not x.strip():
            return [None] * 10
        try:
            p = parse(x)
            return [*(p[n] for n in names), normalize(p), validate(p)]
        except ValueError:
            return [None] * 10

    out = pd.DataFrame([one(x) for x in url], columns=[*names, "normalized", "errors"])
    out["port"] = out["port"].astype("Int64")
    return out


@pandas_udf(StringType())
def resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    """RFC 3986 reference resolution; null where it fails."""

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def canonicalize(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds `parts` (struct), `normalized` (null where rejected or invalid) and `fp`, its SHA-256."""
    url = F.trim(F.col(url_col))
    out = urls.withColumn("parts", url_parts.asNondeterministic()(F.when(~fast_reject(url), url)))
    out = out.withColumn("normalized", F.when(F.size("parts.errors") == 0, F.col("parts.normalized")))
    return out.withColumn("fp", F.sha2("normalized", 256))


def domain(url: Column) -> Column:
    """Network location, user and port included."""
    return F.regexp_extract(url, RFC3986, 2)


def response_filter(pages: DataFrame, *, status: str = "status", content_type: str = "content_type", length: str = "content_length", max_bytes: int = 5 << 20) -> DataFrame:
    """Adds `outcome`: ok, failed (not 200), not_html or too_large, in this order of checks."""
    kind = F.when(F.col(status) != 200, "failed").when(~F.contains(F.lower(F.coalesce(F.col(content_type), F.lit(""))), F.lit("text/html")), "not_html").when(F.coalesce(F.col(length), F.lit(0)) > max_bytes, "too_large").otherwise("ok")
    return pages.withColumn("outcome", kind)


def failed_urls(pages: DataFrame, **columns: str) -> DataFrame:
    """Rows for the sink of failed fetches: url and status of every response that isn't 200."""
    return response_filter(pages, **columns).where("outcome = 'failed'").select("url", F.col(columns.get("status", "status")).cast("int").alias("status"))


def paced(urls: DataFrame, *, url_col: str = "url", delay: float = 1.0) -> DataFrame:
    """Adds `wait`: seconds before a URL may be fetched if its domain is asked once every `delay` seconds, in the order of URLs."""
    return urls.withColumn("wait", (F.row_number().over(Window.partitionBy(domain(F.col(url_col))).orderBy(url_col)) - 1) * F.lit(delay))


def frontier(links: DataFrame, seen: DataFrame | None = None, *, base_col: str = "url", href_col: str = "href") -> DataFrame:
    """New URLs (normalized, fp) among (base, href) pairs: resolved, canonical, distinct and not in `seen` (fp)."""
    found = canonicalize(links.select(resolve(F.col(base_col), F.col(href_col)).alias("link")), "link").where("normalized is not null").select("normalized", "fp").dropDuplicates(["fp"])
    return found if seen is None else found.join(seen.select("fp"), "fp", "left_anti")
