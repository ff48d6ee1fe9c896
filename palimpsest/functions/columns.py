"""Scalar functions of the domain as Column expressions; all stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of reference types.
TYPE_LABELS = {0: "other", 1: "inline", 2: "endnote"}
#: Fixed value: the form of a reference that is nothing but a name.
NAME_ONLY = r"""(?i)^<ref\s+name\s*=\s*(?:"[^"]+"|'[^']+'|[^\s>/]+)\s*/\s*>$"""
#: White space of any kind at either end.
_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: Signs whose compatibility form holds one of / ? # @ : and so would move the end of a host.
_UNSAFE = "\u2048\u2049\u2047\u2100\u2101\u2105\u2106\u2a74\ufe13\ufe16\ufe55\ufe56\ufe5f\ufe6b\uff03\uff0f\uff1a\uff1f\uff20"
_ADDRESS = r"^(?:.*@)?\[(?:[vV][0-9A-Fa-f]+\.[^\[\]]+|[0-9A-Fa-f.]*:[0-9A-Fa-f.]*:[0-9A-Fa-f:.]*(?:%[^\[\]]+)?)\](?::[^\[\]]*)?$"


def stripped(text: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(text, _ENDS, "")


def sha1_text(text: Column) -> Column:
    """Lower-case hex SHA-1 of the UTF-8 text."""
    return F.sha1(text.cast("binary"))


def url_hash(url: Column) -> Column:
    """Lower-case hex MD5 of the UTF-8 url; also of a parameter key, null where it is null."""
    return F.md5(url.cast("binary"))


def template_name_norm(name: Column) -> Column:
    """Underscores as spaces, trimmed, the first letter upper and the rest as it is."""
    clean = stripped(F.translate(name, "_", " "))
    return F.concat(F.upper(F.substring(clean, 1, 1)), clean.substr(F.lit(2), F.length(clean)))


def netloc(url: Column) -> Column:
    """What stands between // and the first of / ? #, with user and port, case kept; '' without //.

    Null where that is no host: brackets without an address in them, or signs that stand
    for one of those that end a host."""
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    broken = host.rlike(r"[\[\]]") & ~host.rlike(_ADDRESS) | host.rlike(f"[{_UNSAFE}]")
    return F.when(~broken, host)


def curid_url(domain: Column, page_id: Column) -> Column:
    """The address of a page by its number."""
    return F.concat(F.lit("https://"), domain, F.lit("/w/index.php?curid="), page_id.cast("string"))


def language_code(domain: Column) -> Column:
    """The first label of a domain."""
    return F.split_part(domain, F.lit("."), F.lit(1))


def clean_timestamp(ts: Column) -> Column:
    """Every T a space, every Z gone; timestamps stay text."""
    return F.translate(ts, "TZ", " ")


def type_label(kind: Column) -> Column:
    """The label of a reference type; an unknown one as decimal text."""
    pairs = [F.lit(x) for item in TYPE_LABELS.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[kind.cast("int")], kind.cast("string"))


def domain_family(domain: Column) -> Column:
    """The family of a wiki's domain: its middle label of three, else its first, capitalised."""
    labels = F.split(domain, r"\.")
    picked = F.when(F.size(labels) == 3, labels[1]).otherwise(labels[0])
    capital = F.concat(F.upper(F.substring(picked, 1, 1)), F.lower(picked.substr(F.lit(2), F.length(picked))))
    return (
        F.when(domain == "species.wikimedia.org", "Wikispecies")
        .when(domain == "commons.wikimedia.org", "Wikimedia Commons")
        .otherwise(capital)
    )


def is_name_only(normalized: Column, name: Column) -> Column:
    """Whether a reference is nothing but a self-closing tag with a name."""
    fits = stripped(normalized).rlike(NAME_ONLY)
    return F.coalesce(fits & (F.length(name) > 0), F.lit(False))


def nth_offset(text: Column, part: Column, n: int) -> Column:
    """0-based place of the n-th occurrence of ``part``, overlaps counted; -1 if fewer."""
    at = F.lit(0)
    for _ in range(n):
        found = F.call_function("locate", part, text, at + 1)
        # A search that failed stays failed.
        at = F.when((at < 0) | (found == 0), -1).otherwise(found)
    return F.when(at < 0, -1).otherwise(at - 1).cast("int")


def parsed_wiki_url(url: Column) -> Column:
    """struct(domain, title, is_curid): what a wiki address names.

    /wiki/X names X as it is written; title= of index.php, decoded, comes before it;
    otherwise curid= marks an address that is a page number already."""
    domain = netloc(url)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    index = path.isin("/w/index.php", "/wiki/index.php")
    written = F.regexp_extract(query, r"(?:^|&)title=([^&]+)", 1)
    title = F.try_url_decode(written)
    in_path = F.regexp_extract(path, r"^/wiki/(.+)$", 1)
    curid = F.regexp_extract(query, r"(?:^|&)curid=([^&]+)", 1)
    is_curid = index & (written == "") & (curid != "")
    named = F.when(index & (written != ""), title).otherwise(F.nullif(in_path, F.lit("")))
    return F.struct(F.nullif(domain, F.lit("")).alias("domain"), F.when(~is_curid, named).alias("title"), is_curid.alias("is_curid"))
