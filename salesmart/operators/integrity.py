"""Referential integrity between tables of any size and any key type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from salesmart.operators.unions import union_by_name


@dataclass(frozen=True)
class ForeignKey:
    child: str
    fk: str
    parent: str
    pk: str


#: Links that one mask has room for; bit 0 of a mask stands for the parent.
MOST_LINKS = 62


def _comparable(column: str, whole: bool) -> list[Column]:
    """A key as whole number, or as trimmed text (``1`` meets ``"1"``) where not all columns that meet are whole numbers."""
    key = F.col(f"`{column}`")
    return [
        (key if whole else F.lit(None)).cast("bigint").alias("number"),
        (F.lit(None).cast("string") if whole else F.trim(key.cast("string"))).alias("text")]


def _roles(tables: dict[str, DataFrame], links: list[ForeignKey]) -> DataFrame:
    """A row per parent key (``parent_key``, its place among the parents of the links) and value, with the roles the value occurs in: bit 0
    where the parent has it, bit ``k`` where
    the child of the ``k``-th link of that parent uses it.

    Each table is read once, whatever number of links it takes part in: a row gives one (parent, value, bit) per role of its
    columns. The bits of a value are combined where it is read, so a value held by most rows costs one row per task.
    """
    by_parent: dict[tuple[str, str], list[ForeignKey]] = {}
    for link in links:
        by_parent.setdefault((link.parent, link.pk), []).append(link)
    roles: dict[str, list[Column]] = {}
    for k, (parent, children) in enumerate(by_parent.items()):
        if len(children) > MOST_LINKS:
            raise ValueError(f"more than {MOST_LINKS} links to {'.'.join(parent)}")
        columns = [parent, *[(link.child, link.fk) for link in children]]
        whole = all(isinstance(tables[table].schema[column].dataType, IntegralType) for table, column in columns)
        for bit, (table, column) in enumerate(columns):
            roles.setdefault(table, []).append(F.struct(
                F.lit(k).alias("parent_key"), *_comparable(column, whole), F.lit(1 << bit).cast("long").alias("mask")))
    held = union_by_name(
        tables[name].select((F.explode(F.array(*own)) if len(own) > 1 else own[0]).alias("held")).select("held.*") for name, own in roles.items())
    used = held.where(F.col("number").isNotNull() | F.col("text").isNotNull())
    return used.groupBy("parent_key", "number", "text").agg(F.bit_or("mask").alias("mask"))


def _numbered(links: list[ForeignKey]) -> list[tuple[ForeignKey, int, int]]:
    """Each link with the place of its parent and its bit among the links of that parent."""
    seen: dict[tuple[str, str], list[int]] = {}
    out = []
    for link in links:
        own = seen.setdefault((link.parent, link.pk), [len(seen), 0])
        own[1] += 1
        out.append((link, *own))
    return out


def _has(bit: int) -> Column:
    return F.col("mask").bitwiseAND(F.lit(1 << bit).cast("long")) != 0


def key_presence(tables: dict[str, DataFrame], links: list[ForeignKey]) -> DataFrame:
    """One row per link and key value, saying on which side the value occurs."""
    sides = [
        F.when((F.col("parent_key") == parent) & (_has(bit) | _has(0)), F.struct(
            F.lit(link.child).alias("child"), F.lit(link.fk).alias("fk"), F.lit(link.parent).alias("parent"),
            _has(bit).alias("in_child"), _has(0).alias("in_parent")))
        for link, parent, bit in _numbered(links)
    ]
    value = F.coalesce(F.col("number").cast("string"), F.col("text")).alias("key_value")
    found = _roles(tables, links).select(value, F.explode(F.array_compact(F.array(*sides))).alias("side"))
    return found.select("side.child", "side.fk", "side.parent", "key_value", "side.in_child", "side.in_parent")


def orphans(tables: dict[str, DataFrame], links: list[ForeignKey]) -> DataFrame:
    """Key values used by a child that its parent does not have."""
    return key_presence(tables, links).where("in_child AND NOT in_parent").select(
        "child", "fk", "parent", F.col("key_value").alias("orphan_value")
    )


def integrity_counts(tables: dict[str, DataFrame], links: list[ForeignKey]) -> DataFrame:
    """Distinct values on either side and orphans, per link. The values become a few numbers per task before they travel on."""
    return (
        key_presence(tables, links)
        .groupBy("child", "fk", "parent")
        .agg(
            F.count_if("in_child").alias("fk_values"),
            F.count_if("in_parent").alias("pk_values"),
            F.count_if(F.col("in_child") & ~F.col("in_parent")).alias("orphan_values"),
        )
    )
