"""Removing repeated runs of lines by winnowing.

Lines are hashed; blank ones do not count. From every line on, the shortest run of lines with at least ``noise`` words is a gram.
Within every stretch of ``guarantee - noise`` words the smallest gram hash is a fingerprint, so every repeated run of
``guarantee`` words or more has a fingerprint wherever it stands, and nothing shorter than ``noise`` words is ever
matched. Each fingerprint is joined to the first place where its gram stands; the match is extended line by line to
both sides, and the later run is deleted. So of a repeated run at least ``noise`` words go; a short line at its edge goes only if
it also stands beside the first place. A deleted line always equals an earlier one, so each text stays somewhere once.

DataFrame functions only. Texts are read twice and shuffled once; everything between handles hashes and places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, unused

NOISE = 40
GUARANTEE = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def grams(docs: DataFrame, doc: list[str], text: str, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """(*doc, pos, at, hash, words, gram, size, chosen) per non-blank line.

    ``pos`` counts the non-blank lines, ``at`` all lines; the gram from the line on spans ``size`` lines and is null where
    the text ends before ``noise`` words; ``chosen`` marks the fingerprints.
    """
    rows = docs.select(*doc, F.posexplode(_lines(F.col(text))).alias("at", "line"))
    rows = rows.withColumn("line", F.trim("line", F.lit(" \t\r\f\x0b"))).filter("line <> ''")
    words = F.size(F.split("line", r"[ \t\r\f\x0B]+"))
    rows = rows.select(*doc, "at", F.xxhash64("line").alias("hash"), words.cast("bigint").alias("words"))
    # Rows equal in id and text are one document. Their lines are combined where they are read, so a row with very many copies sends
    # each line once per task, and to as many tasks as it has lines; only then do a document's lines meet.
    rows = rows.groupBy(*doc, "at").agg(F.min("hash").alias("hash"), F.min("words").alias("words"))
    per = Window.partitionBy(*doc)
    upto = per.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"pos": F.row_number().over(per.orderBy("at")), "done": F.coalesce(F.sum("words").over(upto), F.lit(0))})
    # Every line has a word or more, so the words before a line tell the lines apart and order them.
    span = per.orderBy("done").rangeBetween(0, noise - 1)
    rows = rows.withColumns({"own": F.collect_list("hash").over(span), "held": F.sum("words").over(span)})
    rows = rows.select(*doc, "pos", "at", "hash", "words", "done", F.size("own").alias("size"), F.when(F.col("held") >= noise, F.xxhash64("own")).alias("gram"))
    # Of equal hashes in a stretch the last one counts, as usual in winnowing.
    least = F.min(F.when(F.col("gram").isNotNull(), F.struct("gram", (-F.col("pos")).alias("minus"))))
    rows = rows.withColumn("least", -least.over(per.orderBy("done").rangeBetween(0, guarantee - noise))["minus"])
    picked = F.collect_set("least").over(per.orderBy("done").rangeBetween(noise - guarantee, 0))
    chosen = F.col("gram").isNotNull() & F.array_contains(picked, F.col("pos"))
    return rows.withColumn("chosen", chosen).drop("done", "least")


def _agreeing(x: Column, y: Column) -> Column:
    """Number of leading places in which two arrays of hashes agree."""
    both = F.zip_with(F.slice(x, 1, F.least(F.size(x), F.size(y))), F.slice(y, 1, F.least(F.size(x), F.size(y))), lambda a, b: a == b)
    miss = F.array_position(both, False)
    return F.when(miss > 0, miss - 1).otherwise(F.size(both)).cast("int")


def _within(lines: Column, limit: int) -> Column:
    """Hashes of the leading lines (hash, words) that begin within ``limit`` words."""
    empty = F.struct(F.lit(0).cast("bigint").alias("words"), F.array().cast("array<bigint>").alias("hashes"))
    grow = lambda s, x: F.when(
        s["words"] < limit, F.struct((s["words"] + x["words"]).alias("words"), F.concat(s["hashes"], F.array(x["hash"])).alias("hashes"))
    ).otherwise(s)
    return F.aggregate(lines, empty, grow)["hashes"]


def repeats(lines: DataFrame, doc: list[str], noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """(*doc, pos): the lines to delete, those of every run that matches an earlier one.

    A run reaches at most ``guarantee - noise`` words before its first fingerprint and ``guarantee`` words behind the gram of
    its last one, so matches need not be extended farther than that from any fingerprint.
    """
    prints = lines.filter("chosen").select(*doc, "pos", "gram", "size")
    first = prints.groupBy("gram").agg(F.min(F.struct(*doc, "pos")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    met = prints.join(first.select("gram", "first"), "gram").filter(~F.struct(*doc, "pos").eqNullSafe(F.col("first"))).drop("gram")
    whole = stored(lines.groupBy(*doc).agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "words"))).alias("lines")), "lines_of")
    reach, before, after = F.col("pos") + F.col("size"), guarantee - noise, guarantee
    head = F.reverse(F.slice("lines", F.greatest(F.lit(1), F.col("pos") - before), F.least(F.col("pos") - 1, F.lit(before))))
    # Neighbours are cut out at once, so that no whole text's lines travel on with a match.
    near = met.join(whole, doc).select(
        *doc, "pos", "size", "first", _within(head, before).alias("head"), _within(F.slice("lines", reach, F.lit(after)), after).alias("tail")
    )
    theirs = whole.select(*[F.col(c).alias("f" + c) for c in doc], "lines")
    same = [F.col("first")[c] == F.col("f" + c) for c in doc]
    met = near.join(theirs, same)
    place = F.col("first")["pos"]
    hashes = lambda c: F.transform(c, lambda x: x["hash"])
    their_head = F.reverse(F.slice("lines", F.greatest(F.lit(1), place - before), F.least(place - 1, F.lit(before))))
    fore = _agreeing(F.col("head"), hashes(their_head))
    aft = _agreeing(F.col("tail"), hashes(F.slice("lines", place + F.col("size"), F.lit(after))))
    run = met.select(*doc, (F.col("pos") - fore).alias("start"), (reach + aft - 1).alias("end"))
    return run.select(*doc, F.explode(F.sequence("start", "end")).alias("pos")).distinct()


def without(lines: Column, drop: Column) -> Column:
    """``lines`` less the places in the sorted array ``drop``: the stretches between neighbouring places, put together."""
    bounds = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
    stretch = lambda i: F.slice(lines, F.get(bounds, i - 1) + 2, F.get(bounds, i) - F.get(bounds, i - 1) - 1)
    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(bounds) - 1), stretch))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """``docs`` with the text less its repeated runs, and ``n_dropped``, the number of lines deleted.

    Earlier means a smaller id (nulls last), then a smaller hash of the text, then an earlier line. Rows equal in id and text are
    one document and get the same result. Null and empty texts stay as they are. A line is compared without
    the white space around it; blank lines are neither compared nor deleted. Other columns stay; one called
    ``n_dropped`` is replaced.
    """
    docs = docs.drop("n_dropped") if text != "n_dropped" else docs
    last, own, mark, drop = unused(docs, "_last", "_id", "_hash", "_drop")
    keyed = docs.withColumns({last: F.col(id_col).isNull(), own: F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)), mark: F.xxhash64(F.col(text))})
    key = [last, own, mark]
    distinct = keyed.filter(F.col(text).isNotNull()).select(*key, text)
    rows = stored(grams(distinct, key, text, noise, guarantee), "lines")
    gone = repeats(rows, key, noise, guarantee).join(rows.select(*key, "pos", "at"), [*key, "pos"])
    per_doc = gone.groupBy(*key).agg(F.array_sort(F.collect_set("at")).alias(drop))
    joined = keyed.join(per_doc, key, "left")
    left = F.array_join(without(_lines(F.col(text)), F.col(drop)), "\n")
    return joined.withColumns({"n_dropped": F.coalesce(F.size(drop), F.lit(0)), text: F.when(F.col(drop).isNull(), F.col(text)).otherwise(left)}).select(
        *docs.columns, "n_dropped"
    )
