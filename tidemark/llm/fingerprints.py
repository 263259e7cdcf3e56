"""Document fingerprints: invertible Bloom lookup sketches over paragraph digests.

Only DataFrame functions are used. A text's paragraphs, cut after every 128 code points, are digested to
64 bits; the set of distinct digests is sketched into cells, each digest into one cell of each of three
tables. A cell holds how many digests it has, their xor and the xor of their checks. The sketches of two
versions subtract cell by cell: what both share cancels, and peeling recovers the digests that differ.
Where a sketch is too small for the difference, both sets are sketched again at a size that follows
theirs, split by digest into shares of bounded size; a share that fails is tried again with more cells.

Defined results: null text is empty; empty texts have no digests and two of them are alike (1.0); repeated
paragraphs count once; repeated rows are fingerprinted alike. Next documents: see ``with_next``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of a paragraph that make one digest.
PARAGRAPH = 128
TABLES = 3
#: Cells of each table of a fingerprint.
CELLS = 16
#: Digests of both versions that share one retried sketch on average, and the cells of each table in the tries.
SHARE, RETRIES = 40, (24, 40, 120)
#: Empty cells of a difference of two fingerprints up to which it holds too many digests to be peeled, so it is retried at once.
FREE = 5
#: Peeling ends by itself when no cell is pure; this bounds the rounds.
ROUNDS = 24
#: Ranges of ids for each shuffle partition when documents are put in order.
RANGES = 8

_NO_DIGESTS = "cast(array() as array<bigint>)"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    parts = F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(rf"[^\n]{{1,{PARAGRAPH}}}"), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1)).bitwiseAND(F.lit((1 << 32) - 1))


def _cell(digest: Column, table: int, cells: int) -> Column:
    """The cell of a digest in one table; tables of other sizes use other hashes."""
    return (F.pmod(F.xxhash64(digest, F.lit(1000 * table + cells)), F.lit(cells)) + table * cells).cast("int")


def sketch(found: Column, cells: int = CELLS, minus: Column | None = None) -> Column:
    """array<struct<n, key, check>>: the cells of all tables, one table after the other.

    With ``minus`` it is the sketch of ``found`` less that of ``minus``: sketches are linear, so one pass
    over both sets gives the cells that subtracting two sketches would.
    """
    total, zero = TABLES * cells, F.lit(0).cast("bigint")

    def entries(digests: Column, sign: int) -> Column:
        return F.flatten(
            F.transform(
                digests,
                lambda d: _let(
                    _check(d),
                    lambda k: F.array(
                        *[
                            F.struct(_cell(d, t, cells).alias("cell"), F.lit(sign).alias("n"), d.alias("d"), k.alias("k"))
                            for t in range(TABLES)
                        ]
                    ),
                ),
            )
        )

    # one mark per cell and one at the end, so that every cell has a place in the sorted entries
    marks = F.transform(
        F.sequence(F.lit(0), F.lit(total)),
        lambda c: F.struct(c.alias("cell"), F.lit(-9).alias("n"), zero.alias("d"), zero.alias("k")),
    )

    def cell(own: Column) -> Column:
        n = F.size(own) if minus is None else F.aggregate(own, F.lit(0), lambda a, e: a + e["n"])
        return F.struct(
            n.alias("n"),
            F.aggregate(own, zero, lambda a, e: a.bitwiseXOR(e["d"])).alias("key"),
            F.aggregate(own, zero, lambda a, e: a.bitwiseXOR(e["k"])).alias("check"),
        )

    blank = F.struct(F.lit(0).alias("n"), zero.alias("key"), zero.alias("check"))

    def gathered(x: Column) -> Column:
        def at(c: Column) -> Column:
            begin, end = F.get(x["s"], c), F.get(x["s"], c + 1)
            own = F.slice(x["e"], (begin + 1).cast("int"), (end - begin - 1).cast("int"))
            only = F.get(x["e"], begin.cast("int"))  # the entry after the cell's mark
            alone = F.struct((F.lit(1) if minus is None else only["n"]).alias("n"), only["d"].alias("key"), only["k"].alias("check"))
            return _let(end - begin, lambda held: F.when(held == 1, blank).when(held == 2, alone).otherwise(_let(own, cell)))

        return F.transform(F.sequence(F.lit(0), F.lit(total - 1)), at)

    def placed(ordered: Column) -> Column:
        starts = _let(
            F.transform(ordered, lambda e: e["cell"]),
            lambda at: F.transform(F.sequence(F.lit(0), F.lit(total)), lambda c: F.array_position(at, c)),
        )
        return _let(F.struct(ordered.alias("e"), starts.alias("s")), gathered)

    both = [entries(found, 1)] + ([] if minus is None else [entries(minus, -1)])
    return _let(F.sort_array(F.concat(marks, *both)), placed)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a,
        b,
        lambda x, y: F.struct(
            (x["n"] - y["n"]).alias("n"),
            x["key"].bitwiseXOR(y["key"]).alias("key"),
            x["check"].bitwiseXOR(y["check"]).alias("check"),
        ),
    )


def peel(difference: Column, cells: int = CELLS) -> Column:
    """struct<only_a, only_b, whole>: the digests recovered from a difference, and whether that is all of them."""
    key_type = f"array<struct<d:bigint,n:int,check:bigint,{','.join(f'at{t}:int' for t in range(TABLES))}>>"

    def pure(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))

    def described(c: Column) -> Column:
        at = [_cell(c["key"], t, cells).alias(f"at{t}") for t in range(TABLES)]
        return F.struct(c["key"].alias("d"), c["n"].alias("n"), c["check"].alias("check"), *at)

    def without(held: Column, keys: Column) -> Column:
        def table(t: int) -> Column:
            def taken(c: Column, i: Column) -> Column:
                return F.aggregate(
                    keys,
                    c,
                    lambda a, k: F.when(
                        k[f"at{t}"] == i + t * cells,
                        F.struct(
                            (a["n"] - k["n"]).alias("n"),
                            a["key"].bitwiseXOR(k["d"]).alias("key"),
                            a["check"].bitwiseXOR(k["check"]).alias("check"),
                        ),
                    ).otherwise(a),
                )

            return F.transform(F.slice(held, t * cells + 1, cells), taken)

        return F.concat(*[table(t) for t in range(TABLES)])

    def one_round(s: Column, _: Column) -> Column:
        keys = F.array_distinct(F.transform(F.filter(s["cells"], pure), described))
        return F.when(s["stuck"], s).otherwise(
            _let(
                keys,
                lambda k: F.struct(
                    F.when(F.size(k) == 0, s["cells"]).otherwise(without(s["cells"], k)).alias("cells"),
                    F.concat(s["found"], k).alias("found"),
                    (F.size(k) == 0).alias("stuck"),
                ),
            )
        )

    start = F.struct(
        difference.alias("cells"), F.expr(f"cast(array() as {key_type})").alias("found"), F.lit(False).alias("stuck")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        one_round,
        lambda s: F.struct(
            F.transform(F.filter(s["found"], lambda k: k["n"] > 0), lambda k: k["d"]).alias("only_a"),
            F.transform(F.filter(s["found"], lambda k: k["n"] < 0), lambda k: k["d"]).alias("only_b"),
            F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0)).alias("whole"),
        ),
    )


def _shares(found: Column, shares: Column) -> Column:
    """A set split by digest into at least ``shares`` sets, in two steps so that the work is size * sqrt(shares)."""
    part = lambda d: F.shiftrightunsigned(d, 8)
    wide = F.ceil(F.sqrt(shares)).cast("int")
    deep = F.ceil(shares / wide).cast("int")
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), wide - 1),
            lambda i: _let(
                F.filter(found, lambda d: F.pmod(part(d), wide) == i),
                lambda some: F.transform(
                    F.sequence(F.lit(0), deep - 1),
                    lambda j: F.filter(some, lambda d: F.pmod(F.floor(part(d) / wide), deep) == j),
                ),
            ),
        )
    )


def difference(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """struct<only_a, only_b, whole> of two digest sets through their sketches, retried larger on failure.

    All four should be plain columns of their own projection, so that none is computed more than once.
    """
    unlike = subtract(sketch_a, sketch_b)
    crowded = F.size(F.filter(unlike, lambda c: (c["n"] == 0) & (c["key"] == 0))) <= FREE

    def retried(p: Column, sizes: tuple[int, ...]) -> Column:
        tried = peel(sketch(p["x"], sizes[0], minus=p["y"]), sizes[0])
        return tried if len(sizes) == 1 else _let(tried, lambda r: F.when(r["whole"], r).otherwise(retried(p, sizes[1:])))

    shares = F.ceil((F.size(a) + F.size(b)) / SHARE).cast("int")

    def larger() -> Column:
        split = [F.when(shares <= 1, F.array(s)).otherwise(_shares(s, shares)) for s in (a, b)]
        pairs = F.arrays_zip(split[0].alias("x"), split[1].alias("y"))
        return _let(
            F.transform(pairs, lambda p: retried(p, RETRIES)),
            lambda parts: F.struct(
                F.flatten(F.transform(parts, lambda r: r["only_a"])).alias("only_a"),
                F.flatten(F.transform(parts, lambda r: r["only_b"])).alias("only_b"),
                F.forall(parts, lambda r: r["whole"]).alias("whole"),
            ),
        )

    nothing = F.expr(_NO_DIGESTS)
    spared = F.struct(nothing.alias("only_a"), nothing.alias("only_b"), F.lit(False).alias("whole"))
    first = F.when(crowded, spared).otherwise(peel(unlike))
    return _let(first, lambda r: F.when(r["whole"], r).otherwise(larger()))


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Jaccard similarity of two digest sets from their sizes and their recovered difference."""
    gone, new = F.size(differing["only_a"]), F.size(differing["only_b"])
    union = F.size(a) + new
    return F.when(union == 0, F.lit(1.0)).otherwise((F.size(a) - gone).cast("double") / union)


def encoded(found: Column, cells: Column) -> Column:
    """A sketch as text: set size, then count.key.check of each cell in hexadecimal, empty cells left blank."""
    each = F.transform(
        cells,
        lambda c: F.when(c["n"] == 0, F.lit("")).otherwise(
            F.concat_ws(".", F.hex(c["n"].cast("bigint")), F.hex(c["key"]), F.hex(c["check"]))
        ),
    )
    return F.concat(F.size(found).cast("string"), F.lit(":"), F.array_join(each, ","))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, its digests ``own`` and their sketch ``own_cells``; next_text, next and next_cells: those of the next document.

    Next is by descending id; after the last, the first. A text is digested and sketched once, where its row lies.

    Equal ids follow each other by text, null ids come last; a null text is empty. Ids are cut into ranges
    at their approximate quantiles (a number of bounds that follows the shuffle partitions). The largest
    id of each range also goes, as a marked copy, to the end of the range above, so every range is complete.
    """
    spark = docs.sparkSession
    wanted = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = [i / wanted for i in range(1, wanted + 1)]
    found = docs.agg(F.percentile_approx("doc_id", quantiles, 20 * wanted).alias("q"), F.max("doc_id").alias("top")).first()
    bounds = sorted({*(found["q"] or []), found["top"]} - {None})
    at = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    span = F.struct(F.lit(0).alias("lo"), F.lit(max(0, len(bounds) - 1)).alias("hi"))

    def halved(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        low = F.coalesce(F.col("doc_id") <= F.get(at, mid), F.lit(True))
        return F.struct(
            F.when(low, s["lo"]).otherwise(F.least(mid + 1, s["hi"])).alias("lo"), F.when(low, mid).otherwise(s["hi"]).alias("hi")
        )

    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds).bit_length() + 1)))
    ranged = docs.select(
        "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.aggregate(steps, span, halved, lambda s: s["hi"]).alias("range"),
    )
    largest = F.col("doc_id") == F.get(at, F.col("range")) if bounds else F.lit(True)
    above = (F.col("range") + 1) % max(1, len(bounds))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))
    places = F.when(largest, F.array(own, F.struct(above.alias("range"), F.lit(True).alias("copy")))).otherwise(F.array(own))
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    placed = (
        ranged.withColumn("place", F.explode(places))
        .select("doc_id", "text", F.col("place.range").alias("range"), F.col("place.copy").alias("copy"))
        .repartition("range")
    )
    sketched = placed.withColumn("own", digests(F.col("text"))).withColumn("own_cells", sketch(F.col("own")))
    following = {"next_text": "text", "next": "own", "next_cells": "own_cells"}
    return (
        sketched.withColumns({name: F.lead(c).over(order) for name, c in following.items()})
        .where(~F.col("copy"))
        .select("doc_id", "text", "own", "own_cells", *following)
    )
