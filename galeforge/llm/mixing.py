"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import re
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialize, per_row, private, table

#: Weights by the sources' order, over and over. No source gives more than CAP times what it has.
WEIGHTS, CAP = (5, 2, 1), 3
#: Words in a block, and documents in a shard (shards grow instead beyond MOST_SHARDS a source).
BLOCK, SHARD_DOCS, MOST_SHARDS = 16, 512, 65_536
SEED = "mix-1"
_WORD = re.compile(WORD_PATTERN.encode())


def apportion(cells: DataFrame, group: list[str], weight: str, seats: str, order: list[str]) -> DataFrame:
    """Adds ``quota``: the group's ``seats`` by the highest quotients weight / (2k + 1), ties by ``order``.

    With d = weights / seats, a cell's quota lies within share * cells / 2 + 1 of weight / d, so only quotients
    in that range are laid out and ranked: a number in proportion to the cells, whatever the seats. A group
    without weight gets no seats.
    """
    g = W.partitionBy(*group)
    total, n = F.sum(weight).over(g), F.count("*").over(g)
    x = cells.withColumns({"_t": total, "_n": n}).where("_t is not null")
    share = F.when(F.col("_t") > 0, F.col(weight) / F.col("_t")).otherwise(0.0)
    x = x.withColumns({"_mid": F.floor(share * F.col(seats)), "_half": F.ceil(share * F.col("_n") / 2) + 1})
    x = x.withColumn("_base", F.when(F.col(weight) > 0, F.greatest(F.lit(0), F.col("_mid") - F.col("_half"))).otherwise(0))
    x = x.withColumn("_left", F.col(seats) - F.sum("_base").over(g))
    k = F.explode(F.when(F.col(weight) > 0, F.sequence("_base", F.col("_mid") + F.col("_half"))).otherwise(F.array(F.lit(0).cast("long"))))
    ranked = x.select("*", k.alias("_k")).withColumn("_rank", F.row_number().over(g.orderBy(F.desc(F.col(weight) / (2 * F.col("_k") + 1)), *order, "_k")))
    won = F.sum(F.when((F.col("_rank") <= F.col("_left")) & (F.col(weight) > 0), 1).otherwise(0)) + F.first("_base")
    keep = [c for c in cells.columns]
    return ranked.groupBy(*keep).agg(won.alias("quota"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds ``target`` to (source, source_size): weights share the total, none above cap times its size.

    The capped sources are those with the lowest cap * size / weight; the level of the rest is
    (total - capped sizes) / weights left, for the first prefix of that order above which no source exceeds it.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("_i", F.row_number().over(by_name) - 1)
    s = s.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("_i", F.lit(len(weights))) + 1).cast("int")).cast("long"))
    w = W.orderBy((F.lit(cap) * F.col("source_size")) / F.col("_w"), "_i")
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumns(
        {
            "_total": F.sum("source_size").over(everything),
            "_capped": F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "_rest": F.sum("_w").over(w.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    level = (F.col("_total") - F.col("_capped")) / F.col("_rest")
    s = s.withColumn("_level", F.when(level * F.col("_w") <= cap * F.col("source_size"), level))
    s = s.withColumn("_level", F.max("_level").over(everything))
    cap_at = (F.lit(cap) * F.col("source_size")).cast("double")
    return s.withColumn("target", F.when(F.col("_level").isNull(), cap_at).otherwise(F.least(cap_at, F.col("_level") * F.col("_w")))).drop("_i", "_w", "_total", "_capped", "_rest", "_level")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, block: int = BLOCK, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the mix takes of every row: the kept columns, doc_id, source, size, source_size, target, passes, from_word, part_words, wrap_words, taken.

    Sources' targets become whole blocks of ``block`` words by Sainte-Laguë, then each source's blocks
    become quotas of its shards (of the rows, by a seeded hash). A shard lays its rows end to end in seeded order;
    a quota is whole passes over all its blocks and a seeded circular run of the rest. A row is taken ``passes``
    times whole, and once more its ``part_words`` words after word ``from_word`` and its first ``wrap_words``.
    Null texts have size 0; a null source is a source of its own, last; rows that repeat count each. Shards
    with no words take nothing; an empty table gives an empty result.
    """
    own = materialize(docs.select(*keep, "doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    own = own.withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))))
    sums = own.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    goal = targets(sums, weights, cap).withColumn("_shards", F.least(F.lit(MOST_SHARDS), F.ceil(F.col("_docs") / SHARD_DOCS)).cast("long"))
    goal = goal.withColumn("_seats", F.floor(F.sum("source_size").over(W.partitionBy()) / block).cast("long")).withColumn("_all", F.lit(0))
    goal = apportion(goal, ["_all"], "target", "_seats", ["source"]).withColumnRenamed("quota", "_blocks").drop("_all", "_seats")
    placed = own.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = placed.withColumn("_shard", F.pmod(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long"), F.col("_shards")))
    cells = placed.groupBy("source", "_shard").agg(F.sum("size").alias("_cell"), F.first("_blocks").alias("_blocks"))
    quotas = apportion(cells, ["source"], "_cell", "_blocks", ["_shard"]).select(F.col("source").alias("_s"), F.col("_shard").alias("_h"), "_cell", "quota")
    laid = placed.withColumn("_end", F.sum("size").over(W.partitionBy("source", "_shard").orderBy("_key", "size", "doc_id", *keep).rowsBetween(W.unboundedPreceding, 0)))
    laid = laid.join(quotas, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))
    laid = laid.withColumn("_n", F.ceil(F.col("_cell") / block)).withColumn("passes", F.when(F.col("_n") > 0, F.least(F.lit(cap), F.floor(F.col("quota") / F.col("_n")))).otherwise(0).cast("long"))
    laid = laid.withColumn("_rest", F.when((F.col("_n") > 0) & (F.col("passes") < cap), F.col("quota") - F.col("passes") * F.col("_n")).otherwise(0))
    laid = laid.withColumn("_at", F.when(F.col("_n") > 0, F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit("-")), F.col("_shard").cast("string"))), 1, 8), 16, 10).cast("long"), F.col("_n"))).otherwise(0))
    start = F.col("_end") - F.col("size")
    lo, hi = F.col("_at") * block, F.least((F.col("_at") + F.col("_rest")) * block, F.col("_cell"))
    wrap = F.greatest(F.lit(0), F.col("_at") + F.col("_rest") - F.col("_n")) * block
    laid = laid.withColumn("from_word", F.greatest(F.lit(0), lo - start))
    laid = laid.withColumn("part_words", F.greatest(F.lit(0), F.least(hi, F.col("_end")) - F.greatest(lo, start)))
    laid = laid.withColumn("wrap_words", F.greatest(F.lit(0), F.least(wrap, F.col("_end")) - start))
    taken = (F.col("passes") * F.col("size") + F.col("part_words") + F.col("wrap_words")).cast("long")
    return laid.select(*keep, "doc_id", "source", "size", "source_size", "target", "passes", "from_word", "part_words", "wrap_words", taken.alias("taken"))


OP7_SQL = r"""
with own as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5('mix-1:' || coalesce(cast(doc_id as varchar), '-')) as key from documents
), sums as (
  select source, cast(sum(size) as bigint) as source_size, count(*) as docs,
         [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as w, row_number() over (order by source nulls last) as i
  from own group by source
), levels as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (order by (3 * source_size)::double / w, i rows between unbounded preceding and 1 preceding), 0))::double
            / (sum(w) over (order by (3 * source_size)::double / w, i rows between current row and unbounded following))::double as l from sums
), goal as (
  select *, coalesce(least((3 * source_size)::double, (max(case when l * w <= 3 * source_size then l end) over ()) * w), (3 * source_size)::double) as target,
         cast(floor((sum(source_size) over ())::double / 16) as bigint) as seats, least(65536, cast(ceil(docs::double / 512) as bigint)) as shards from levels
), a1 as (
  select *, sum(target) over (order by source rows between unbounded preceding and unbounded following) as t, count(*) over () as n from goal
), a2 as (
  select *, case when t > 0 then target / t else 0 end as share from a1
), a3 as (
  select *, cast(floor(share * seats) as bigint) as mid, cast(ceil(share * n / 2) as bigint) + 1 as half from a2
), a4 as (
  select *, case when target > 0 then greatest(0, mid - half) else 0 end as base from a3
), a5 as (
  select *, seats - sum(base) over () as open_seats from a4
), a6 as (
  select source, base, open_seats, target, row_number() over (order by target / (2 * k + 1) desc, source nulls first, k) as r
  from (select *, unnest(case when target > 0 then range(base, mid + half + 1) else [0] end) as k from a5)
), blocks as (
  select source, max(base) + count(*) filter (where r <= open_seats and target > 0) as blocks from a6 group by source
), placed as (
  select o.*, g.source_size, g.target, g.shards, b.blocks, ('0x' || substr(o.key, 1, 8))::bigint % g.shards as shard
  from own o join goal g on o.source is not distinct from g.source join blocks b on o.source is not distinct from b.source
), cells as (
  select source, shard, cast(sum(size) as bigint) as cell, max(blocks) as seats from placed group by source, shard
), b1 as (
  select *, sum(cell) over (partition by source) as t, count(*) over (partition by source) as n from cells
), b2 as (
  select *, case when t > 0 then cell::double / t else 0 end as share from b1
), b3 as (
  select *, cast(floor(share * seats) as bigint) as mid, cast(ceil(share * n / 2) as bigint) + 1 as half from b2
), b4 as (
  select *, case when cell > 0 then greatest(0, mid - half) else 0 end as base from b3
), b5 as (
  select *, seats - sum(base) over (partition by source) as open_seats from b4
), b6 as (
  select *, row_number() over (partition by source order by cell::double / (2 * k + 1) desc, shard, k) as r
  from (select *, unnest(case when cell > 0 then range(base, mid + half + 1) else [0] end) as k from b5)
), quotas as (
  select source, shard, cell, max(base) + count(*) filter (where r <= open_seats and cell > 0) as quota from b6 group by source, shard, cell
), laid as (
  select p.*, q.cell, q.quota, cast(ceil(q.cell::double / 16) as bigint) as nb,
         sum(p.size) over (partition by p.source, p.shard order by p.key, p.size, p.doc_id rows unbounded preceding) as fin
  from placed p join quotas q on p.source is not distinct from q.source and p.shard = q.shard
), turns as (
  select *, case when nb > 0 then least(3, quota // nb) else 0 end as passes,
         case when nb > 0 then ('0x' || substr(md5('mix-1:' || coalesce(source, '-') || ':' || cast(shard as varchar)), 1, 8))::bigint % nb else 0 end as pos from laid
), rests as (
  select *, case when nb > 0 and passes < 3 then quota - passes * nb else 0 end as rest, fin - size as start from turns
)
select doc_id, size, source_size, target,
  cast(passes * size + greatest(0, least(least((pos + rest) * 16, cell), fin) - greatest(pos * 16, start))
    + greatest(0, least(greatest(0, pos + rest - nb) * 16, fin) - start) as bigint) as taken
from rests
"""


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def take(docs: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """The mix itself: each row of docs as often as the plan takes it, the parts cut out of its text at words; n_chars, if there is one, is that of the piece.

    Rows are told apart by doc_id and their text's hash; of rows that repeat both, each takes one of the plan's, in a fixed order. Other columns may
    have any names. A null text is taken no times, as it has no words; an empty table gives an empty result.
    """
    of = lambda text: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text.cast("string"))
    plan = mix(docs.select("doc_id", F.xxhash64("text").alias("hash"), "source", "text"), keep=("hash",)) if plan is None else plan
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("at"), F.col("size").alias("n")), F.col("passes").cast("int"))
    some = F.array(F.struct(F.col("from_word").cast("long").alias("at"), F.col("part_words").cast("long").alias("n")), F.struct(F.lit(0).cast("long").alias("at"), F.col("wrap_words").cast("long").alias("n")))
    pieces = F.filter(F.concat(whole, some), lambda p: p["n"] > 0)
    names = [private(x, docs) for x in ("key", "rank", "size", "at", "n", "taken")]
    key, rank, size, at, n, taken = names
    cut = plan.groupBy(of(F.col("hash")).alias(key)).agg(F.sort_array(F.collect_list(F.struct("size", pieces.alias("pieces")))).alias(taken))
    order = [F.xxhash64(*docs.columns)] if docs.columns else []
    own = docs.withColumn(key, of(F.xxhash64("text"))).join(cut.where(F.exists(taken, lambda x: F.size(x["pieces"]) > 0)), key)
    own = own.withColumn(rank, F.row_number().over(W.partitionBy(key).orderBy(*order)))
    one = F.element_at(F.col(taken), F.col(rank))
    rows = own.select(*docs.columns, one["size"].alias(size), F.explode(one["pieces"]).alias(taken))

    def start():
        def piece(text, size, at, n):
            if at == 0 and n == size:
                return text
            raw = text.encode()
            words = _WORD.finditer(raw)
            first = next(islice(words, at, None))
            last = first if n == 1 else next(islice(words, n - 2, None))
            return raw[first.start() : last.end()].decode()

        return lambda x: {key: [piece(*row) for row in zip(x["text"], x[size], x[at], x[n], strict=True)]}

    rest = tuple(c for c in docs.columns if c != "text")
    out = per_row(rows.withColumns({at: F.col(f"`{taken}`.at"), n: F.col(f"`{taken}`.n")}).drop(taken), ["text", size, at, n], start, {key: "string"}, rest)
    out = out.withColumn("n_chars", F.length(key).cast("long")) if "n_chars" in docs.columns else out
    return out.withColumnRenamed(key, "text").select(*docs.columns)
