"""Text expressions. All are plain Spark expressions; only entities that need a table go through an Arrow UDF."""

from __future__ import annotations

import html
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's split() sees it.
SPACE = r"(?U)[\s\x1c-\x1f]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(T.StringType())
def _unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda x: html.unescape(x) if x is not None and "&" in x else x)


def unescape_basic(c: Column | str) -> Column:
    """The five entities of XML, in the JVM; ``&amp;`` last, so that nothing is decoded twice."""
    c = _col(c)
    for entity, text in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(text))
    return c


def clean_text(c: Column | str, entities: str = "all") -> Column:
    """Entities decoded first, then markup deleted without a gap, white space collapsed and trimmed; empty becomes null.
    ``entities`` is ``all`` (every HTML entity, by an Arrow UDF) or ``basic`` (XML's five, in the JVM)."""
    c = _col(c)
    c = _unescape(c) if entities == "all" else unescape_basic(c)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), SPACE, " ")), F.lit(""))


def present(c: Column | str) -> Column:
    """Neither null nor blank."""
    return F.coalesce(F.trim(F.regexp_replace(_col(c).cast("string"), SPACE, " ")) != "", F.lit(False))


def missing_falsy(c: Column | str) -> Column:
    """Null or empty, as tables count a missing value."""
    return F.coalesce(_col(c).cast("string") == "", F.lit(True))


def missing_blank(c: Column | str) -> Column:
    """Null or blank, as profiles count a missing value."""
    return ~present(c)


def join_values(c: Column | str, sep: str = "; ") -> Column:
    """An array's distinct non-blank values in first-seen order, joined; null if there are none."""
    kept = F.filter(F.transform(_col(c), lambda x: F.nullif(F.trim(F.regexp_replace(x, SPACE, " ")), F.lit(""))), lambda x: x.isNotNull())
    return F.nullif(F.array_join(F.array_distinct(kept), sep), F.lit(""))


def int_or_null(c: Column | str) -> Column:
    return F.expr(f"try_cast({c} AS BIGINT)") if isinstance(c, str) else c.try_cast("bigint")


def strip_ends(c: Column | str) -> Column:
    """White space collapsed, blanks, semicolons, commas and full stops taken off both ends; empty becomes null."""
    return F.nullif(F.btrim(F.regexp_replace(_col(c), SPACE, " "), F.lit(" ;,.")), F.lit(""))


def truncate_words(c: Column | str, limit: int) -> Column:
    """At most ``limit`` characters: a longer text is clipped, its last word dropped if there is another, and an
    ellipsis set. For single-spaced text."""
    c = _col(c)
    clipped = F.rtrim(F.left(c, F.lit(max(0, limit - 1))))
    words = F.when(F.contains(clipped, F.lit(" ")), F.regexp_replace(F.regexp_replace(clipped, " [^ ]*$", ""), "[ ;,.]+$", "")).otherwise(clipped)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(words, F.lit("…")))


#: Order of the parts of a composed text: label (none for the first) and column.
PARTS = ((None, "title"), ("Object type", "object_type"), ("Scientific name", "scientific_name"), ("Creator", "creator"), ("Date", "date"), ("Place", "place"), ("Topics", "topics"))


def model_text(parts: Sequence[tuple[str | None, str]] = PARTS, description: str | None = "description", max_chars: int = 512, description_max_chars: int = 240) -> Column:
    """Labelled parts joined to one text: each value once without regard to letter case, the description at the end if
    nothing said it before, all within ``max_chars``. Empty text if every part is missing."""
    if max_chars <= 0 or description_max_chars < 0:
        raise ValueError("max_chars must be positive and description_max_chars not negative")
    all_parts = F.filter(F.array(*[F.struct(F.lit(label).cast("string").alias("l"), strip_ends(c).alias("v")) for label, c in parts]), lambda x: x["v"].isNotNull())
    lowered = F.transform(all_parts, lambda x: F.lower(x["v"]))
    kept = F.filter(all_parts, lambda x, i: F.array_position(lowered, F.lower(x["v"])) == i + 1)
    shown = F.transform(kept, lambda x: F.when(x["l"].isNull(), x["v"]).otherwise(F.concat(x["l"], F.lit(": "), x["v"])))
    if description and description_max_chars:
        d = strip_ends(description)
        extra = F.when(d.isNotNull() & ~F.coalesce(F.array_contains(lowered, F.lower(d)), F.lit(False)), F.concat(F.lit("Description: "), truncate_words(d, description_max_chars)))
        shown = F.array_compact(F.array_append(shown, extra))
    text = F.concat(F.array_join(shown, ". "), F.when(F.size(shown) > 0, ".").otherwise(""))
    return F.when(F.length(text) <= max_chars, text).otherwise(F.concat(F.regexp_replace(truncate_words(text, max_chars - 1), r"\.+$", ""), F.lit(".")))


def contains_term(c: Column | str, terms: Sequence[str]) -> Column:
    """Whether any of the terms stands in the text as a whole word or phrase, letter case ignored: ``grave`` isn't in
    ``engraved``. Blank terms never match; a null text has none. One compiled pattern for all terms."""
    quoted = [r"\Q" + t.strip().lower().replace(r"\E", r"\E\\E\Q") + r"\E" for t in terms if t.strip()]
    if not quoted:
        return F.lit(False)
    return F.coalesce(F.lower(_col(c)).rlike(r"(?U)(?<!\w)(?:" + "|".join(quoted) + r")(?!\w)"), F.lit(False))


def contains_keyword(c: Column | str, keywords: Sequence[str]) -> Column:
    """Whether any keyword is a substring, letter case ignored: ``print`` is in ``blueprint``."""
    low = F.lower(_col(c))
    out = F.lit(False)
    for k in keywords:
        out = out | F.coalesce(F.contains(low, F.lit(k.lower())), F.lit(False))
    return out


def media_host(c: Column | str) -> Column:
    """Host in lower case if the text has ``://``, else empty."""
    c = _col(c)
    return F.when(F.contains(c, F.lit("://")), F.lower(F.split_part(c, F.lit("/"), F.lit(3)))).otherwise("")


def netloc(c: Column | str) -> Column:
    """Host part as written; empty if there is none."""
    return F.coalesce(F.regexp_extract(_col(c), "^[^:/?#]+://([^/?#]*)", 1), F.lit(""))


def derivative_url(c: Column | str, host: str, side: int = 512, path: str = "/ids/deliveryService") -> Column:
    """The address of a scaled rendition at one delivery host; any other address unchanged. ``<path>/id/...`` gets the side
    as its last path part, in place of a number there; ``<path>?id=...`` gets ``max``, in place if it is there."""
    c = _col(c)
    own = F.lower(netloc(c)) == host.lower()
    head, query = F.regexp_extract(c, r"^[^?#]*", 0), F.regexp_extract(c, r"\?([^#]*)", 1)
    frag = F.regexp_extract(c, r"#.*$", 0)
    tail = F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    bare = F.regexp_replace(head, "/+$", "")
    by_path = F.concat(F.regexp_replace(bare, r"/\d+$", ""), F.lit(f"/{int(side)}"), tail, frag)
    has_max = query.rlike(r"(?:^|&)max=")
    set_max = F.when(has_max, F.regexp_replace(query, r"(^|&)max=[^&]*", f"$1max={int(side)}")).otherwise(F.concat(query, F.lit(f"&max={int(side)}")))
    by_query = F.concat(head, F.lit("?"), set_max, frag)
    return F.when(own & F.contains(head, F.lit(f"{path}/id/")), by_path).when(own & F.endswith(bare, F.lit(path)) & query.rlike(r"(?:^|&)id="), by_query).otherwise(c)
