"""Source divergence audit: how far the sources of one language differ in their use of terms, and by which terms.

A source's share ``p`` of a term depends on nothing but the source and how often the term stands in it, its count level. So the
distance of two sources is fixed by their joint table: for each pair of levels the number of terms at these levels. The tables of
all pairs of sources are the product of one matrix with its transpose, whose rows are terms and whose columns are
indicators, one for each (source, level) that occurs. The product is taken in blocks: rows are dealt into blocks of about
``ROWS`` terms, columns into blocks of about ``GROUPS`` sources, and each task multiplies one pair of column blocks over one row block,
prices the joint tables it gets and returns one sum per pair of sources. Pricing is linear in the table, so the sums add up.
Level 0 is a column like any other, for the terms that some source of the task has; all others stand at the cell (0, 0) of the task's tables.

All arithmetic is in integers. An indicator product counts at most a block's terms, which 32-bit floats hold without rounding; prices
are 64-bit integers; shares are taken from decimals.

Rows: null text, lang and source are ''. A repeated row counts each time, a repeated id as well; ids are not read. Every (lang, source)
that occurs has its pairs, also without terms; an empty table gives an empty report. Texts are read whole, in
slices inside a task, and counted out before the shuffle, so that neither a hot source nor a long text meets in one task. Ties in value are
ranked by the UTF-8 bytes of the item. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.textbatch import LOWER, byte_array, slices, split_words, text_bytes
from gradeloom.sources.workdir import stored

ROWS = 256  # terms in a row block of the product, about
GROUPS = 32  # sources in a column block, about
FLUSH_TERMS = 1 << 21  # (group, term) counts of slices held by a task before they are added up and sent on
SCALE = 1_000_000_000
SMOOTHING = 5

#: Bytes outside terms: ASCII but for letters.
NO_TERM = np.ones(256, dtype=bool)
NO_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_COUNTED = "lang string, source string, term string, n bigint, docs bigint"


def _terms_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The terms of a batch in lower case, and the number of each term's row."""
    data, offsets = text_bytes(batch.column("text"))
    words = split_words(LOWER[data], offsets, NO_TERM)
    return words.array(), words.text


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and rows that hold the term. A group without terms has one row with a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        told: set[int] = set()
        held: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            """The counts held, added up by group and term, and the groups seen so far."""
            groups, terms, n, rows = (list(part) for part in zip(*held))
            encoded = pa.concat_arrays(terms).dictionary_encode()
            code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            key, at = np.unique(np.concatenate(groups) * max(len(encoded.dictionary), 1) + code, return_inverse=True)
            group, word = key // max(len(encoded.dictionary), 1), key % max(len(encoded.dictionary), 1)
            fresh = np.array([k for k in names.values() if k not in told], np.int64)
            told.update(fresh.tolist())
            total = [np.bincount(at, weights=np.concatenate(x), minlength=len(key)).astype(np.int64) for x in (n, rows)]
            term = encoded.dictionary.take(pa.array(np.append(word, np.full(len(fresh), -1)), mask=np.append(word < 0, np.full(len(fresh), True))))
            group = pa.array(np.append(group, fresh))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, _ in names], pa.string()).take(group),
                    pa.array([source for _, source in names], pa.string()).take(group),
                    term.cast(pa.binary()).cast(pa.string()),
                    *(pa.array(np.append(t, np.zeros(len(fresh), np.int64))) for t in total),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

        size = 0
        for part in slices(batches):
            terms, row = _terms_of(part)
            group = np.array([names.setdefault((g["lang"], g["source"]), len(names)) for g in part.select(["lang", "source"]).to_pylist()], np.int64)
            encoded = terms.dictionary_encode()
            code, width = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(encoded.dictionary), 1)
            in_row, often = np.unique(row * width + code, return_counts=True)  # a row's distinct terms
            key, at = np.unique(group[in_row // width] * width + in_row % width, return_inverse=True)
            n, rows_with = np.bincount(at, weights=often, minlength=len(key)), np.bincount(at, minlength=len(key))
            held.append((key // width, encoded.dictionary.take(pa.array(key % width)), n, rows_with))
            size += len(key)
            if size >= FLUSH_TERMS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    found = docs.select(text("lang"), text("source"), text("text")).mapInArrow(run, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * v))`` in exact decimals; ``v`` is above 0."""
    above = (n.cast("decimal(20,0)") + F.lit(SMOOTHING).cast("decimal(2,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + SMOOTHING * v).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


class Shares:
    """Kept terms of each language with the shares of each source that has them, stored once for both parts of the report."""

    def __init__(self, docs: DataFrame, min_docs: int):
        counted = count_terms(docs)
        of_term = Window.partitionBy("lang", "term")  # a row per source that has the term
        both = counted.withColumns({"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)})
        both = stored(both.where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)).drop("docs", "lang_docs"), "terms")
        terms = both.where("term is not null")
        langs = (
            terms.groupBy("lang", "term").agg(F.first("lang_n").alias("n"))
            .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
        )
        totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        nothing = F.lit(0).cast("long")
        #: One row per (lang, source), with terms or without.
        self.groups = stored(
            both.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", F.coalesce("total", nothing).alias("total"), F.coalesce("v", nothing).alias("v"), F.coalesce("lang_total", nothing).alias("lang_total"))
            .withColumn("p0", F.when(F.col("v") > 0, _share(nothing, F.col("total"), F.col("v"))).otherwise(nothing)),
            "groups",
        )
        #: One row per kept term and source that has it.
        self.terms = terms.join(self.groups, ["lang", "source"]).select(
            "lang", "source", "term", "n", "v", "p0",
            _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
        )


def one_hot(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicator columns of a table of levels (terms x sources), with each column's source and level, by source."""
    n_rows, n_groups = levels.shape
    group = np.broadcast_to(np.arange(n_groups), levels.shape)
    columns, column = np.unique(np.stack((group.ravel(), levels.ravel()), axis=1), axis=0, return_inverse=True)
    matrix = np.zeros((n_rows, len(columns)), np.float32)
    matrix[np.repeat(np.arange(n_rows), n_groups), column.reshape(-1)] = 1
    return matrix, columns[:, 0], columns[:, 1]


def price(left: tuple, right: tuple, left_p: np.ndarray, right_p: np.ndarray) -> np.ndarray:
    """Sum of share differences for each pair of sources of two blocks, from the joint tables of their levels.

    ``left`` and ``right`` are what ``one_hot`` gives, ``left_p`` and ``right_p`` the shares at their columns.
    """
    (x, x_group, _), (y, y_group, _) = left, right
    joint = (x.T @ y).astype(np.int64)
    priced = joint * np.abs(left_p[:, None] - right_p[None, :])
    by_left = np.add.reduceat(priced, np.flatnonzero(np.diff(x_group, prepend=-1)), axis=0)
    return np.add.reduceat(by_left, np.flatnonzero(np.diff(y_group, prepend=-1)), axis=1)


_PRICES = "lang string, source string, item string, value bigint, covered bigint"


def _block_prices(table: pa.Table) -> pa.Table:
    """Prices of all pairs of sources that lie in a pair of column blocks, over one row block.

    Rows without a term name a source of the blocks and its share at level 0, the others give a term's level in a source.
    """
    lang, own, other = (table.column(c)[0].as_py() for c in ("lang", "own", "other"))
    is_source = np.array(table.column("term").is_null().to_numpy())
    places: dict[int, tuple] = {}
    if is_source.all() or len(set(table.column("block").to_pylist())) < len({own, other}):  # no term, or no source on one side
        return pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("covered", pa.int64())]).empty_table()
    terms = table.filter(pa.array(~is_source))
    encoded = terms.column("term").combine_chunks().dictionary_encode()
    row, n_rows = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(encoded.dictionary)
    for block in {own, other}:
        named = table.filter(pa.array(is_source & (table.column("block").to_numpy() == block)))
        names = named.column("source").to_pylist()
        number = {name: k for k, name in enumerate(names)}
        mine = terms.column("block").to_numpy() == block
        group = np.array([number[s] for s in terms.column("source").filter(pa.array(mine)).to_pylist()], np.int64)
        levels = np.zeros((n_rows, len(names)), np.int64)
        shares = np.broadcast_to(named.column("p").to_numpy(), levels.shape).copy()
        levels[row[mine], group] = terms.column("n").to_numpy()[mine]
        shares[row[mine], group] = terms.column("p").to_numpy()[mine]
        hot = one_hot(levels)
        places[block] = names, hot, shares[np.argmax(hot[0], axis=0), hot[1]]
    (x_names, x, x_p), (y_names, y, y_p) = places[own], places[other]
    value = price(x, y, x_p, y_p)
    a, b = (k.ravel() for k in np.indices(value.shape))
    source, item, value = [x_names[k] for k in a], [y_names[k] for k in b], value.ravel()
    if own != other:
        source, item, value = source + item, item + source, np.tile(value, 2)
    return pa.table(
        {
            "lang": pa.array([lang] * len(source), pa.string()),
            "source": pa.array(source, pa.string()),
            "item": pa.array(item, pa.string()),
            "value": pa.array(value, pa.int64()),
            "covered": pa.array(np.full(len(source), n_rows), pa.int64()),
        }
    )


def pair_distances(shares: Shares, rows: int = ROWS, groups: int = GROUPS) -> DataFrame:
    """``lang, source, item, value``: for each ordered pair of sources of a language the sum of share differences over all kept terms."""
    sizes = shares.groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    blocks = shares.groups.join(sizes, "lang").select(
        "lang", "source", "p0", "v",
        F.ceil(F.col("v") / rows).cast("int").alias("row_blocks"), F.ceil(F.col("sources") / groups).cast("int").alias("blocks"),
    ).withColumn("block", F.expr("cast(pmod(xxhash64(source), blocks) as int)"))
    entries = shares.terms.join(blocks.select("lang", "source", "row_blocks", "blocks", "block"), ["lang", "source"]).select(
        "lang", "source", "term", "n", "p", "block", "blocks", F.expr("cast(pmod(xxhash64(term), row_blocks) as int)").alias("rows")
    )
    named = blocks.where("row_blocks > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.col("p0").alias("p"), "block", "blocks",
        F.explode(F.expr("sequence(0, row_blocks - 1)")).alias("rows"),
    )
    dealt = entries.unionByName(named).withColumn("mate", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "lang", "source", "term", "n", "p", "block", "rows", F.least("block", "mate").alias("own"), F.greatest("block", "mate").alias("other")
    )
    priced = dealt.groupBy("lang", "rows", "own", "other").applyInArrow(_block_prices, _PRICES)
    sums = priced.where("source <> item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))
    mates = shares.groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"))
    pairs = shares.groups.select("lang", "source", "p0", "v").join(mates, "lang").where("source <> item")
    nothing = F.lit(0).cast("long")
    rest = (F.col("v") - F.coalesce("covered", nothing)) * F.abs(F.col("p0") - F.col("item_p0"))
    return pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", (F.coalesce("value", nothing) + rest).alias("value"))


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the other sources (``pair``), and the terms a source uses more than its language (``term``)."""
    shares = Shares(docs, min_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_distances(shares).withColumn("rank", F.row_number().over(order))
    above = shares.terms.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["item", "value", "rank"]
    return pairs.select("lang", "source", F.lit("pair").alias("part"), *columns).unionByName(terms.select("lang", "source", F.lit("term").alias("part"), *columns))
