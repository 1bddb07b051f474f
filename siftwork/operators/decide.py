"""Decisions with reasons: staged predicate rules, an ordered decision list, and their roll-ups. The rules are data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import contains_keyword, present


@dataclass(frozen=True)
class Rule:
    """``code`` becomes a reason where ``when`` is true; null counts as false."""

    code: str
    when: Column


def reasons(rules: Sequence[Rule]) -> Column:
    """The codes of all rules that hold, in order, each once."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*[F.when(F.coalesce(r.when, F.lit(False)), F.lit(r.code)) for r in rules])))


def staged(stages: Sequence[Sequence[Rule]]) -> Column:
    """Reasons of the first stage that has any; later stages don't run for the row."""
    out = reasons(stages[-1])
    for stage in reversed(stages[:-1]):
        own = reasons(stage)
        out = F.when(F.size(own) > 0, own).otherwise(out)
    return out


def decision(hard: Sequence[Sequence[Rule]], soft: Sequence[Rule], names: tuple[str, str, str] = ("rejected", "review_required", "eligible")) -> Column:
    """struct(status, reasons): hard stages reject, soft rules ask for review, else the row passes with no reasons."""
    no, maybe = staged(hard), reasons(soft)
    return F.when(F.size(no) > 0, F.struct(F.lit(names[0]).alias("status"), no.alias("reasons"))).otherwise(F.struct(F.when(F.size(maybe) > 0, names[1]).otherwise(names[2]).alias("status"), maybe.alias("reasons")))


def useful_fields(fields: Sequence[str], title: str, rejected_titles: Sequence[str], id_like: str) -> Column:
    """How many fields are present. A title that is among ``rejected_titles`` or matches the pattern ``id_like`` says nothing
    and isn't counted."""
    n = sum((present(f).cast("int") for f in fields), F.lit(0))
    t = F.lower(F.trim(F.col(title)))
    empty = present(title) & (t.isin(*[x.lower() for x in rejected_titles]) | t.rlike(id_like))
    return n - F.coalesce(empty, F.lit(False)).cast("int")


def fixed_schema(df: DataFrame, schema: Mapping[str, str], sep: str = "|") -> DataFrame:
    """The columns of ``schema``, in its order and with its types: missing ones null, values that don't fit null, arrays
    joined by ``sep`` where text is asked for."""

    def cell(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind)
        if kind == "string" and df.schema[name].dataType.typeName() == "array":
            return F.array_join(name, sep)
        return F.col(name).try_cast(kind)

    return df.select(*[cell(n, k).alias(n) for n, k in schema.items()])


def decision_list(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """The label of the first rule that holds."""
    out = F.lit(default)
    for when, label in reversed(rules):
        out = F.when(F.coalesce(when, F.lit(False)), F.lit(label)).otherwise(out)
    return out


def keyword_rule(columns: Sequence[str], keywords: Sequence[str]) -> Column:
    """Any keyword is a substring of the fields' texts put together, letter case ignored."""
    return contains_keyword(F.concat_ws(" ", *[F.col(c) for c in columns]), keywords)


def lookup(c: Column | str, table: Mapping[str, str]) -> Column:
    """The label of a code; a code without one is an error, null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, c)
    return F.when(c.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("no label for "), c)))


def status_counts(df: DataFrame, column: str = "status") -> DataFrame:
    return df.groupBy(F.coalesce(column, F.lit("")).alias(column)).agg(F.count("*").alias("n"))


def reason_counts(df: DataFrame, column: str = "reasons") -> DataFrame:
    return df.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
