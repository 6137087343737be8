"""Interaction of text filters: what each removes, alone and in every order, with exact Shapley shares.

Every document is reduced to the set of filters that it fails, a bit mask. Documents are counted by part and mask (at most 32
rows for a part), so all that follows works on counts, whatever the number of documents:

* the removals of each of the 32 coalitions of filters are tabulated;
* a filter's share is the solution of the least-squares fit of an additive game to those removals, weighted by the Shapley
  kernel and constrained to add up to the removals of all filters. The normal equations are solved in rationals, so the share
  times 120 is exact: the filter's removals summed over all 120 orders;
* the counts of a step in an order are differences of coalition removals.

Duplicates (filter E) are never gathered: of the rows of one digest only the least id is found, by a minimum that is combined
before the shuffle, and joined back by digest and id. So a text that a third of all rows hold stays spread.

Defined cases: a null text is an empty one (no words, so it fails A, and E if a smaller id is empty too); null and empty sources
are one part, the empty string; a null ``doc_id`` has no labels, never fails E and makes no other row fail it; rows that repeat
an id count once each, and do not fail E because of each other; of several label rows of an id one with the value 1 is enough;
an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.llm.tables import keep

FILTERS = "ABCDE"
SPACE = "[\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def failures(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, digest, mask)``: bits 0 to 3 of the mask stand for the filters A to D, digest for the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    split = rows.select("doc_id", "part", "text", F.array_remove(F.split("text", SPACE), "").alias("words"))
    n, different = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.octet_length("text") - F.octet_length(F.translate("text", CAPITALS, ""))
    tests = [n < 200, 100 * different < 50 * n, 100 * capitals > 2 * F.length("text"), F.col("text").rlike("[#$%&*|]")]
    mask = sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))
    return split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``, 0 or 1, by id."""
    marks = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("quality") == 1, 1).otherwise(0).alias("good"),
        F.when(F.col("toxic") == 1, 1).otherwise(0).alias("toxic"),
    )
    marks = marks.where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])


def profiles(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and failed filters, of them those labelled good and toxic."""
    rows = keep(labelled(failures(docs), labels), "filter-failures")
    least = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = rows.join(least, ["digest", "doc_id"])

    def counted(some: DataFrame, bit: int, sign: int) -> DataFrame:
        return some.groupBy("part", (F.col("mask") + bit).alias("mask")).agg(
            (sign * F.count(F.lit(1))).alias("n"), (sign * F.sum("good")).alias("good"), (sign * F.sum("toxic")).alias("toxic")
        )

    # All rows with an id fail E, but for the first of each text.
    copy = 1 << FILTERS.index("E")
    parts = [counted(rows.where("doc_id is not null"), copy, 1), counted(firsts, copy, -1), counted(firsts, 0, 1)]
    parts.append(counted(rows.where("doc_id is null"), 0, 1))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).where("n > 0")


def removals(counts: Iterable[tuple[int, int]], filters: int) -> list[int]:
    """For each coalition of filters, by its bit mask, the documents that fail at least one of them."""
    counts = list(counts)
    return [sum(n for mask, n in counts if mask & coalition) for coalition in range(1 << filters)]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    rows = [[*line, value] for line, value in zip(matrix, right, strict=True)]
    for i in range(len(rows)):
        pivot = next(j for j in range(i, len(rows)) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [value / rows[i][i] for value in rows[i]]
        for j in range(len(rows)):
            if j != i and rows[j][i]:
                factor = rows[j][i]
                rows[j] = [a - factor * b for a, b in zip(rows[j], rows[i], strict=True)]
    return [line[-1] for line in rows]


def shares(removed: list[int], filters: int) -> list[Fraction]:
    """Shapley values as the weighted least squares with the sum of all shares fixed (Lagrange multiplier last)."""
    size = filters + 1
    matrix = [[Fraction(0)] * size for _ in range(size)]
    right = [Fraction(0)] * size
    for coalition in range(1, (1 << filters) - 1):
        members = [i for i in range(filters) if coalition >> i & 1]
        weight = Fraction(filters - 1, comb(filters, len(members)) * len(members) * (filters - len(members)))
        for i in members:
            right[i] += weight * removed[coalition]
            for j in members:
                matrix[i][j] += weight
    for i in range(filters):
        matrix[i][filters] = matrix[filters][i] = Fraction(1)
    right[filters] = Fraction(removed[-1])
    if filters == 1:
        return [right[filters]]
    return solve(matrix, right)[:filters]


def steps(part: str, rows: pd.DataFrame, filters: str = FILTERS) -> list[tuple]:
    """The rows of the result for one part, from its counts by mask."""
    k = len(filters)
    n, good, toxic = (removals(zip(rows["mask"].tolist(), rows[c].tolist(), strict=True), k) for c in ("n", "good", "toxic"))
    total = int(rows["n"].sum())
    share = [value * factorial(k) for value in shares(n, k)]
    alone = dict(zip(rows["mask"].tolist(), rows["n"].tolist(), strict=True))
    out = []
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            gone = n[after] - n[before]
            out.append(
                (
                    part, "".join(filters[j] for j in order), step, total - n[after], gone, n[1 << i] - gone, alone.get(1 << i, 0),
                    good[after] - good[before], toxic[after] - toxic[before], int(share[i]),
                )
            )
            before = after
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see the module and ``RESULT``."""
    names = [field.split()[0] for field in RESULT.split(", ")]

    def of_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(steps(key[0], rows), columns=names)

    return profiles(docs, labels).groupBy("part").applyInPandas(of_part, RESULT)


#: The same by plain SQL: every order is walked for every group of documents that fail the same filters.
SQL = r"""with letters(f) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (select a.f || b.f || c.f || d.f || e.f as filter_order
           from letters a, letters b, letters c, letters d, letters e
           where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (select filter_order, step, substr(filter_order, step, 1) as f, substr(filter_order, 1, step - 1) as earlier
          from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
texts as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels group by doc_id),
failed as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
             case when len(w) < 200 then 'A' else '' end
             || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
             || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end
             || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
             || case when doc_id > first then 'E' else '' end as fails
           from (select *, min(doc_id) over (partition by t) as first from texts) left join marks using (doc_id)),
groups as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by part, fails),
walked as (select part, filter_order, step, f, n, good, toxic, fails = f as alone, contains(fails, f) as bad,
             earlier = '' or not regexp_matches(fails, '[' || case earlier when '' then '-' else earlier end || ']') as here
           from groups, steps),
counted as (select part, filter_order, step, any_value(f) as f,
              coalesce(sum(n) filter (here and not bad), 0)::bigint as kept, coalesce(sum(n) filter (here and bad), 0)::bigint as removed,
              coalesce(sum(n) filter (bad and not here), 0)::bigint as redundant, coalesce(sum(n) filter (alone), 0)::bigint as unique_fails,
              coalesce(sum(good) filter (here and bad), 0)::bigint as good_lost,
              coalesce(sum(toxic) filter (here and bad), 0)::bigint as toxic_lost
            from walked group by part, filter_order, step)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley from counted"""
