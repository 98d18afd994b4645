"""Headers, labels, keys and URLs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header(name: str) -> str:
    """One column name in normal form."""
    out = name.strip().replace("\n", " ").replace("  ", " ").lower().replace(" ", "_")
    return re.sub(r"[()]", "", out).replace("%", "pct")


def normal_headers(df: DataFrame) -> DataFrame:
    """All headers in normal form; names that then clash get _2, _3, ... in their order."""
    seen: dict[str, int] = {}
    out = []
    for name in map(header, df.columns):
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*out)


def with_missing(df: DataFrame, constants: Mapping[str, object], overwrite: Iterable[str] = ()) -> DataFrame:
    """Adds constant columns that are missing; those in overwrite always."""
    return df.withColumns({c: F.lit(v) for c, v in constants.items() if c not in df.columns or c in set(overwrite)})


def rename_aliases(df: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """Renames the first present alias to its target, if the target is missing."""
    for target, names in aliases.items():
        found = next((n for n in names if n in df.columns), None)
        if target not in df.columns and found:
            df = df.withColumnRenamed(found, target)
    return df


def resolve(columns: Iterable[str], aliases: Iterable[str]) -> str | None:
    """The column whose name without punctuation and case equals one of the aliases'."""
    bare = lambda s: re.sub(r"[^a-z0-9]", "", s.lower())
    by = {bare(c): c for c in reversed(list(columns))}
    return next((by[bare(a)] for a in aliases if bare(a) in by), None)


def resolve_tokens(columns: Iterable[str], tokens: Iterable[str]) -> str | None:
    """The first column whose name holds all tokens."""
    tokens = [t.lower() for t in tokens]
    return next((c for c in columns if all(t in c.lower() for t in tokens)), None)


def first_present(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """The first candidate that is a column."""
    there = set(columns)
    return next((c for c in candidates if c in there), None)


def spaced_key(c: Column) -> Column:
    """lower-case letters and digits, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9 ]", ""), r"\s+", " "))


def bare_key(c: Column) -> Column:
    """lower-case letters and digits only."""
    return F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "")


def mapped(c: Column, table: Mapping[str, str]) -> Column:
    """squeezed label, through an alias table where it has an entry."""
    key = squeezed(c)
    if not table:
        return key
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(entries, key), key)


def metric_name(c: Column) -> Column:
    """lower case, runs of anything else an underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def squeezed(c: Column) -> Column:
    """trimmed, white space as single spaces."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def safe_label(c: Column) -> Column:
    """'Unknown' for null and empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("Unknown"))


def is_aggregate_label(c: Column) -> Column:
    """Labels of totals, on the spaced key."""
    return c.isin("total", "india", "all india", "all") | c.startswith("all ")


def document_key(*parts: Column) -> Column:
    """parts joined by |, nulls as empty."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def file_alias(path: str) -> str:
    """A table alias for a path: its sanitised beginning (45 characters at most) and a stable number."""
    number = 0
    for ch in path:
        number = (31 * number + ord(ch)) % ((1 << 31) - 1)
    return f"{re.sub(r'[^A-Za-z0-9]+', '_', path).strip('_')[:45] or 'dataset'}_{number}"


#: Query parameters that only track; besides these, all that begin with utm_.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source")
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once a row, however often f names it: Spark would write an expression out at each place."""
    return F.element_at(F.transform(F.array(value), f), 1)


def form_decoded(c: Column) -> Column:
    """a key or value of a query string: + is a space, percent codes are bytes of UTF-8. A % without
    two hexadecimal digits stays; bytes that aren't UTF-8 become the replacement character."""
    return F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def form_encoded(c: Column) -> Column:
    """a text as a key or value of a query string: letters, digits and _.-~ as they are, a space as +, other bytes as percent codes."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


#: Fixed value: the parts of a URI reference (scheme, //authority, path, ?query, #fragment).
_REFERENCE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def without_dots(path: Column) -> Column:
    """A path without its segments . and .., a fold over its segments: .. takes back the
    segment before, but never the root; one of them at the end leaves a slash."""
    parts = F.split(path, "/")
    rooted = path.startswith("/")
    segments = F.when(rooted, F.slice(parts, 2, F.size(parts))).otherwise(parts)
    step = lambda held, x: F.when(x == ".", held).when(x == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))).otherwise(F.concat(held, F.array(x)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    ends = F.element_at(parts, -1).isin(".", "..")
    joined = F.concat(F.when(rooted, "/").otherwise(""), F.array_join(kept, "/"))
    return F.when(ends & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolved(base: Column, reference: Column) -> Column:
    """What a reference on a page means, by RFC 3986 (5.2): references with a scheme as they
    are, but for dots in their path; `//host` with the base's scheme; paths from the base's host or
    from the base's folder; ?query and #fragment of the base's page. White space around both goes.
    Null is empty, and an empty reference is the base without its fragment; without a base with a
    scheme, the reference itself."""
    trim = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")
    names = ("scheme", "host", "path", "query", "fragment")
    of = lambda c: let(trim(c), lambda r: F.struct(r.alias("all"), *[F.regexp_extract(r, _REFERENCE, i).alias(n) for i, n in enumerate(names, 1)]))

    def together(x: Column) -> Column:
        b, r = x["b"], x["r"]
        folder = F.when((b["host"] != "") & (b["path"] == ""), "/").otherwise(F.regexp_replace(b["path"], "[^/]*$", ""))
        # what loses its dots: an own path from the root, or one below the base's folder
        path = let(F.when((r["scheme"] != "") | (r["host"] != "") | r["path"].startswith("/"), r["path"]).otherwise(F.concat(folder, r["path"])), without_dots)
        own = F.when(r["path"] == "", b["path"]).otherwise(path)
        asked = F.when((r["path"] == "") & (r["query"] == ""), b["query"]).otherwise(r["query"])
        opaque = (r["host"] == "") & ~r["path"].startswith("/")
        absolute = F.concat(r["scheme"], F.lit(":"), r["host"], F.when(opaque, r["path"]).otherwise(path), r["query"], r["fragment"])
        there = F.when(r["host"] != "", F.concat(r["host"], path, r["query"])).otherwise(F.concat(b["host"], own, asked))
        return F.when(r["scheme"] != "", absolute).when(b["scheme"] == "", r["all"]).otherwise(F.concat(b["scheme"], F.lit(":"), there, r["fragment"]))

    return let(F.struct(of(base).alias("b"), of(reference).alias("r")), together)


def normal_url(c: Column) -> Column:
    """lower-case scheme and host, single slashes in the path and none at its end, the query
    without tracking keys, no fragment. The query's keys and values are decoded, sorted by key (values
    of a key stay in their order), and encoded again. `//host` gets https; what has no scheme or host
    stays as it is; null is empty. Percent codes of the path stay as written."""
    after = lambda p: F.when(p.contains("="), F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("")

    def of(raw: Column) -> Column:
        part = lambda i: F.regexp_extract(raw, _URL, i)
        path = F.regexp_replace(F.regexp_replace(part(3), "/{2,}", "/"), "/+$", "")
        items = F.transform(F.filter(F.split(part(4), "&"), lambda p: p != ""), lambda p, i: F.struct(form_decoded(F.substring_index(p, "=", 1)).alias("key"), i.alias("i"), form_decoded(after(p)).alias("value")))
        kept = F.filter(items, lambda x: ~F.lower(x["key"]).startswith("utm_") & ~F.lower(x["key"]).isin(*TRACKING))
        query = F.array_join(F.transform(F.array_sort(kept), lambda x: F.concat(form_encoded(x["key"]), F.lit("="), form_encoded(x["value"]))), "&")
        whole = let(F.struct(path.alias("p"), query.alias("q")), lambda x: F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.when(x["p"] == "", "/").otherwise(x["p"]), F.when(x["q"] != "", F.concat(F.lit("?"), x["q"])).otherwise("")))
        return F.when(raw.startswith("//"), F.concat(F.lit("https:"), raw)).when(part(1) == "", raw).otherwise(whole)

    return let(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", ""), of)


def file_url(c: Column) -> Column:
    """trimmed, spaces as %20."""
    return F.replace(F.trim(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit("%20"))


def unescaped(c: Column) -> Column:
    """escaped slashes of a JSON payload as slashes."""
    return F.regexp_replace(c, r"\\u002[Ff]|\\/", "/")


def from_template(url: Column, resource_id: Column) -> Column:
    """{resource_id} filled in; null where the id is missing or a placeholder."""
    known = resource_id.isNotNull() & (resource_id != "") & ~resource_id.startswith("PLACEHOLDER_")
    return F.when(~url.contains("{resource_id}"), url).when(known, F.replace(url, F.lit("{resource_id}"), resource_id))


#: Addresses that aren't public (private, loopback, link-local, documentation, multicast, reserved).
_CLOSED = r"^(0\.|10\.|127\.|169\.254\.|172\.(1[6-9]|2\d|3[01])\.|192\.168\.|192\.0\.[02]\.|198\.1[89]\.|198\.51\.100\.|203\.0\.113\.|22[4-9]\.|2[3-5]\d\.)"
_QUAD = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def host_of(c: Column) -> Column:
    """The host in lower case, without a dot at its end; empty where there is none."""
    authority = F.regexp_extract(F.trim(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_extract(authority, r"([^@]*)$", 1), r":\d*$", "")
    return F.regexp_replace(F.lower(host), r"\.+$", "")


def is_public_url(c: Column, hosts: Iterable[str] = (), suffixes: Iterable[str] = ()) -> Column:
    """P25: http(s), no credentials, a host that is neither this machine nor a closed address, and,
    if hosts or suffixes are given, one of the hosts, or a suffix or below one. Of addresses in
    brackets only global ones (2000::/3) are public. Null and unparsable: false."""
    host = host_of(c)
    closed = (host == "localhost") | host.endswith(".localhost") | (host.rlike(_QUAD) & host.rlike(_CLOSED)) | (host.startswith("[") & ~host.rlike(r"^\[[23][0-9a-f]{3}:"))
    authority = F.regexp_extract(F.trim(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    ok = F.trim(c).rlike(r"^(?i)https?://") & ~authority.contains("@") & (host != "") & ~closed
    known, below = [h.lower().rstrip(".") for h in hosts], [h.lower().rstrip(".") for h in suffixes]
    if known or below:
        allowed = host.isin(*known) if known else F.lit(False)
        for s in below:
            allowed = allowed | (host == s) | host.endswith("." + s)
        ok = ok & allowed
    return F.coalesce(ok, F.lit(False))


def allowed_hosts(*fields: Column) -> Column:
    """The distinct hosts of URL, host or array-of-URL columns of a descriptor, sorted."""
    host = lambda u: host_of(F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u)))
    every = F.flatten(F.array(*[F.coalesce(f, F.array().cast("array<string>")) for f in fields]))
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.array_compact(every), host), lambda h: h != "")))
