"""URL expressions: entity decoding, resolution against a base (RFC 3986) and
registered domains by public-suffix rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Named character references that are decoded, `&amp;` last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
HTTP = r"(?i)^https?:"
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def decode_entities(c: Column) -> Column:
    """Numeric (decimal and hexadecimal) and the named references of
    ``ENTITIES``; anything else stays as it is.  Null stays null."""
    def one(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"([0-9A-Fa-f]+);$", 1)
        code = F.when(F.lower(F.substring(ref, 3, 1)) == "x", F.lpad(digits, 8, "0")).otherwise(
            F.lpad(F.conv(digits, 10, 16), 8, "0"))
        # code points that are no character (surrogates, beyond U+10FFFF) become U+FFFD
        number = F.conv(code, 16, 10).cast("long")
        sound = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(sound, F.decode(F.unhex(code), "UTF-32")).otherwise(F.lit("�"))

    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});)"), F.lit(1)))
    out = F.aggregate(refs, c, lambda text, ref: F.replace(text, ref, one(ref)))
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def authority(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)


def host(url: Column) -> Column:
    """Host of an absolute URL, lower-cased, without user and port."""
    return F.lower(F.regexp_extract(authority(url), r"^(?:[^@]*@)?([^:]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved; '/' at least."""
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    kept = F.aggregate(parts, F.lit(""), lambda out, s: F.when(s == ".", out)
                       .when(s == "..", F.regexp_replace(out, r"/[^/]*$", "")).otherwise(F.concat(out, F.lit("/"), s)))
    closed = F.when(path.rlike(r"/\.\.?$"), F.concat(kept, F.lit("/"))).otherwise(kept)
    return F.when(closed == "", F.lit("/")).otherwise(closed)


def resolve(base: Column, href: Column) -> Column:
    """The absolute URL of a reference against an absolute http(s) base, without
    its fragment; null where the reference has another scheme (``mailto:``)."""
    ref = F.regexp_replace(F.regexp_replace(href, r"[\t\r\n]", ""), r"^[\x00-\x20]+|[\x00-\x20]+$|#.*$", "")
    scheme = F.regexp_extract(base, r"^([A-Za-z]+):", 1)
    site = F.concat(scheme, F.lit("://"), authority(base))
    path, query = F.regexp_extract(ref, r"^([^?]*)", 1), F.regexp_extract(ref, r"^[^?]*(\?.*)?$", 1)
    folder = F.regexp_replace(F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base)), r"[^/]*$", "")
    whole = F.when(ref.rlike(HTTP + "//"), ref).when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
    whole = F.concat(F.regexp_extract(whole, r"^([^:]+://)", 1), authority(whole), without_dots(
        F.when(path_of(whole) == "", F.lit("/")).otherwise(path_of(whole))), F.regexp_extract(whole, r"^[^?]*(\?.*)?$", 1))
    return (F.when(ref.rlike(HTTP + "//") | ref.startswith("//"), whole)
            .when(ref.rlike(_SCHEME), F.lit(None).cast("string"))
            .when(ref == "", F.regexp_replace(base, r"#.*$", ""))
            .when(ref.startswith("?"), F.concat(site, path_of(base), ref))
            .when(ref.startswith("/"), F.concat(site, without_dots(path), query))
            .otherwise(F.concat(site, without_dots(F.concat(folder, path)), query)))


def scheme_of(href: Column) -> Column:
    """Scheme of a reference in lower case, '' for a relative one."""
    return F.lower(F.regexp_extract(F.trim(href), _SCHEME, 1))


def with_registered_domain(df: DataFrame, host_col: str, rules: DataFrame, name: str = "registered_domain") -> DataFrame:
    """``df`` with the registered domain of a host: its public suffix and one
    label more; null where the host is a public suffix itself, null or empty.

    ``rules``: (rule), a public-suffix list as the caller has it: plain rules
    (``co.uk``), wildcards (``*.ck``: any one label before ``ck``) and
    exceptions (``!www.ck``).  An exception wins, else the longest match, else
    the last label.  IPv4 addresses stand for themselves.

    Each distinct host asks for its own suffixes only, by an equality join with
    the rules; then the hosts' answers join back.
    """
    r = rules.select(F.lower(F.trim("rule")).alias("rule")).filter(F.length("rule") > 0).distinct()
    r = r.select(F.regexp_replace("rule", r"^(\*\.|!)", "").alias("__suffix"),
                 F.when(F.col("rule").startswith("!"), F.lit(-1)).when(F.col("rule").startswith("*."), F.lit(1))
                 .otherwise(F.lit(0)).alias("__more"))
    clean = F.regexp_replace(F.lower(F.col(host_col)), r"\.$", "")
    hosts = df.select(F.col(host_col).alias("__host")).filter(F.length("__host") > 0).distinct()
    hosts = hosts.withColumn("__labels", F.split(F.regexp_replace(F.lower("__host"), r"\.$", ""), r"\."))
    asked = hosts.select("__host", "__labels", F.explode(F.sequence(F.lit(1), F.size("__labels"))).alias("__n"))
    asked = asked.withColumn("__suffix", F.array_join(F.slice("__labels", F.size("__labels") - F.col("__n") + 1, F.col("__n")), "."))
    met = asked.join(r, "__suffix").filter(F.col("__n") + F.col("__more") <= F.size("__labels"))
    best = met.groupBy("__host").agg(F.max(F.struct((F.col("__more") == -1).alias("exception"),
                                                    (F.col("__n") + F.col("__more")).alias("labels"))).alias("__best"))
    found = hosts.join(best, "__host", "left")
    size = F.coalesce(F.col("__best.labels"), F.lit(1)) + 1
    domain = F.when(F.size("__labels") >= size, F.array_join(F.slice("__labels", F.size("__labels") - size + 1, size), "."))
    found = found.select("__host", domain.alias("__found"))
    out = df.join(found, F.col(host_col) == F.col("__host"), "left")
    address = clean.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    return out.withColumn(name, F.when(address, clean).otherwise(F.col("__found"))).drop("__host", "__found")
