"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Of the hashes of all
``GRAM``-word grams, the smallest in every window of ``WIDTH`` words is a fingerprint. A span of WIDTH words that a document
shares with an item therefore shares a fingerprint. Fingerprints of documents are joined to those of
the items; around each occurrence of a joined one the words are compared, and the hit extends as far as
they agree. Items shorter than a window are their own fingerprint and must occur as a whole.

Everything is DataFrame and SQL functions. To a document come one row per distinct position of a hit and
one per item that it holds a window of; nothing is gathered per fingerprint. The work on one text grows in
proportion to its words and to the places of the items' fingerprints in it. Arrays are exploded as outer:
of a plain explode Spark makes a filter by size, pushes it below the arrays' columns, and computes these
anew for every element.

Cases: a null or empty text has no words; an item without words has no windows; ties of smallest hashes
are the same hash and cannot lose a span; items with the same words are items of their own, rows with
the same item_id one item; the words of a row without item_id are hit like any others, but it is named and
counted in no list of items; repeated documents give repeated results; further columns are ignored; empty tables on
either side are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm.staging import documents, free_name, staged

WIDTH = 10
GRAM = 5

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _GAPS, _LOWER + " " * len(_GAPS))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")


def _grams(hashes: Column, n: int) -> Column:
    """Hashes of all runs of n words, from the words' hashes; none for fewer words."""
    last = F.size(hashes) - n + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(n))))


def _smallest(rows: DataFrame, grams: str, width: int, name: str) -> DataFrame:
    """Rows with the distinct smallest hashes of all runs of ``width`` grams as column ``name``.

    The smallest of a run is that of two shorter runs that cover it, so each gram is looked at once per
    doubling of the width. Every step is a column of its own, or each would be computed twice in the next.
    """
    count = F.greatest(F.size(grams) - width + 1, F.lit(0))
    out, reach = rows.withColumn(name, F.col(grams)), 1
    while reach < width:
        step = min(reach, width - reach)
        # beyond the end there are nulls, which F.least skips; what they touch is cut off below
        shifted = F.slice(name, step + 1, F.greatest(F.size(name), F.lit(1)))
        out = out.withColumn(name, F.zip_with(name, shifted, lambda x, y: F.least(x, y)))
        reach += step
    return out.withColumn(name, F.array_distinct(F.slice(name, F.lit(1), count)))


def _places(hashes: Column, n: int) -> Column:
    """(fp, at, n) of all grams of n words."""
    return F.transform(_grams(hashes, n), lambda g, i: F.struct(g.alias("fp"), i.alias("at"), F.lit(n).alias("n")))


def _around(at: Column, reach: int, width: int) -> tuple[Column, Column]:
    """The ``reach`` words of column ``w`` ahead of a place, nearest first, and ``width`` words from it."""
    ahead = F.slice("w", F.greatest(at - reach + 1, F.lit(1)), F.least(at, F.lit(reach)))
    return F.reverse(ahead), F.slice("w", at + 1, F.lit(width))


def _hashes(words_column: str) -> Column:
    return F.transform(words_column, lambda w: F.xxhash64(w))


def index_items(items: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Fingerprints of items (item_id, text): (fp, n, item_id, need, before, after).

    ``n`` words are hashed, ``need`` words must agree; ``before`` holds the words ahead of the gram, nearest
    first, and ``after`` those from its start.
    """
    own = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    own = own.filter(F.size("w") > 0).withColumn("h", _hashes("w")).withColumn("g", _grams(F.col("h"), gram))
    long = _smallest(own.filter(F.size("w") >= width), "g", width - gram + 1, "kept")
    long = long.withColumn("item_key", F.xxhash64("item_id", "w"))
    # every place of a kept gram, also one that was not the smallest there; the words around it are cut
    # before the places become rows, so no row carries its item
    def entry(fp: Column, at: Column) -> Column:
        before, after = _around(at, width - gram, width)
        return F.struct(fp.alias("fp"), before.alias("before"), after.alias("after"))

    entries = long.select("item_id", "item_key", F.explode_outer(F.transform("g", entry)).alias("e"))
    kept = long.select("item_key", F.explode_outer("kept").alias("fp")).distinct()
    long = entries.select("item_id", "item_key", "e.*").join(kept, ["item_key", "fp"], "left_semi").select(
        "fp", F.lit(gram).alias("n"), "item_id", F.lit(width).alias("need"), "before", "after"
    )
    short = own.filter(F.size("w") < width).select(
        F.xxhash64(F.slice("h", F.lit(1), F.size("h"))).alias("fp"), F.size("w").alias("n"), "item_id",
        F.size("w").alias("need"), F.array().cast("array<string>").alias("before"), F.col("w").alias("after"),
    )
    return long.unionByName(short).distinct()


def _row_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key by which equal rows, and practically only these, are the same."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row_key", F.xxhash64("doc_id", "text")
    )


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return (a["row_key"] == b["row_key"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def _agreeing(a: Column, b: Column) -> Column:
    """How many elements two arrays share from their start."""
    differ = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: F.coalesce(p["a"] == p["b"], F.lit(False)))
    first = F.array_position(differ, False)
    return F.when(first > 0, first - 1).otherwise(F.size(differ))


def marked(docs: DataFrame, items: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, row_key, copies, n_words, n_hit, item_ids) for every different row of ``docs``."""
    index = staged(index_items(items, width, gram), "benchmark-index")
    known = index.select("fp").distinct()
    # at most width - 1 lengths below a window
    lengths = sorted(r["n"] for r in index.filter(F.col("need") < width).select("n").distinct().collect())
    rows = _row_keys(docs).select("doc_id", "row_key", words(F.col("text")).alias("w"))
    rows = rows.select("doc_id", "row_key", F.size("w").alias("n_words"), _hashes("w").alias("h"))
    # a column of its own: inside the function of every window the grams would be computed anew
    rows = rows.withColumn("g", _grams(F.col("h"), gram))
    rows = _smallest(rows, "g", width - gram + 1, "kept")
    fps = F.array_distinct(F.concat("kept", *(_grams(F.col("h"), n) for n in lengths)))
    exploded = rows.select("doc_id", "row_key", "n_words", F.posexplode_outer(fps).alias("at", "fp"))
    found = staged(known.withColumn("known", F.lit(True)), "benchmark-fingerprints")
    per_row = (
        exploded.join(found, "fp", "left").filter("known or coalesce(at, 0) = 0").groupBy("doc_id", "row_key", "n_words")
        .agg(
            F.count_if(F.coalesce(F.col("at"), F.lit(0)) == 0).alias("copies"),
            F.collect_set(F.when(F.col("known"), F.col("fp"))).alias("fps"),
        )
    )
    per_row = staged(per_row, "winnowed")
    suspects = per_row.filter(F.size("fps") > 0).select("doc_id", "row_key")
    texts = _row_keys(docs)
    full = texts.join(suspects, _same_row(texts, suspects)).select(
        suspects["doc_id"], suspects["row_key"], words(F.col("text")).alias("w")
    )
    # places of the items' fingerprints, for each length of gram, as narrow rows; then the words around them
    hashed = full.select("doc_id", "row_key", _hashes("w").alias("h"))
    places = F.concat(*(_places(F.col("h"), n) for n in sorted({gram, *lengths})))
    placed = hashed.select("doc_id", "row_key", F.explode_outer(places).alias("place")).select("doc_id", "row_key", "place.*")
    placed = placed.join(index.select("fp", "n").distinct(), ["fp", "n"], "left_semi").groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("fp", "n", "at")).alias("places")  # at most the words of one text, a length
    ).select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "places")

    def place(p: Column) -> Column:
        left, right = _around(p["at"], width - gram, width)
        return F.struct(p["fp"].alias("fp"), p["n"].alias("n"), p["at"].alias("at"), left.alias("left"), right.alias("right"))

    same = (F.col("row_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    hits = full.join(placed, same).select(
        "doc_id", "row_key", F.explode_outer(F.transform("places", place)).alias("place")
    ).select("doc_id", "row_key", "place.*").distinct()
    compared = hits.join(index, ["fp", "n"]).select(
        "doc_id", "row_key", "at", "item_id", "need",
        _agreeing(F.col("left"), F.col("before")).alias("ahead"), _agreeing(F.col("right"), F.col("after")).alias("behind"),
    ).filter(F.col("ahead") + F.col("behind") >= F.col("need"))
    compared = staged(compared, "benchmark-hits")
    runs = compared.groupBy("doc_id", "row_key", "at").agg(F.max("ahead").alias("ahead"), F.max("behind").alias("behind"))
    # a run reaches width words to either side, so a document has at most one run per word
    spans = runs.groupBy("doc_id", "row_key").agg(
        F.sort_array(F.collect_list(F.struct((F.col("at") - F.col("ahead")).alias("lo"), (F.col("at") + F.col("behind")).alias("hi")))).alias("runs")
    )
    covered = F.aggregate(
        "runs", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(r["hi"] - F.greatest(r["lo"], a["end"]), F.lit(0))).cast("int").alias("n"),
            F.greatest(a["end"], r["hi"]).cast("int").alias("end"),
        ),
    )["n"]
    spans = spans.select("doc_id", "row_key", covered.cast("long").alias("n_hit"))
    named = compared.select("doc_id", "row_key", "item_id").distinct().groupBy("doc_id", "row_key").agg(
        F.sort_array(F.collect_list("item_id")).alias("item_ids")  # leaves out null
    )
    # both have one row per contaminated document
    both = spans.join(named, _same_row(spans, named)).select(spans["doc_id"], spans["row_key"], "n_hit", "item_ids")
    return per_row.join(both, _same_row(per_row, both), "left").select(
        per_row["doc_id"], per_row["row_key"], "copies", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with all their columns."""
    bad = staged(marked(docs, items, width, gram).filter("n_hit > 0").select("doc_id", "row_key"), "contaminated")
    key = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
    own, mine = free_name(docs.columns, "_row_key"), free_name(docs.columns, "_bad_key")
    number = free_name(docs.columns, "_bad_id")
    bad = bad.select(F.col("doc_id").alias(number), F.col("row_key").alias(mine))
    rows = docs.withColumn(own, key)
    same = (F.col(own) == F.col(mine)) & F.col("doc_id").cast("long").eqNullSafe(F.col(number))
    return rows.join(bad, same, "left_anti").select(*docs.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = marked(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select(
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "*"
    ).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
