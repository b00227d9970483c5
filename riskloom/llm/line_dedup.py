"""Line deduplication by content-defined chunks of lines, in DataFrame functions only.

A text's lines are hashed (28 bits of MD5), a rolling hash runs over ``window`` line hashes, and a non-blank line ends a
chunk where the rolling hash is divisible by ``divisor``; a line of ``min_words`` words or more is a chunk of its own (with
the blank lines before it), and the last line ends the last chunk.  Boundaries depend on the lines near them alone, so
they come back into step after inserted or deleted lines.  Chunks that occur more than once in the table are compared
byte by byte with their first occurrence (smallest doc_id, then position in the text).  Successive later copies, and blank
chunks beside them, make a run, which is removed if it has ``min_lines`` non-blank lines or one of ``min_words`` words,
and ``min_bytes`` bytes (line ends included); the first occurrence of a chunk stays.

Null texts count as empty (one blank line).  A text that loses all its chunks stays as an empty text.  Rows that repeat
doc_id and text are one document and lose the same chunks; a chunk that repeats inside a text loses its later copies.
Only digests are grouped, with map-side aggregation, so a chunk that a third of all documents share is one row there.

``passage_dedup`` has the finest chunks, which the lines of a passage's neighbours cannot blur: every two successive
non-blank lines (with the blank ones between) and every line of ``MIN_WORDS`` words or more.  A repeated passage of two
or more non-blank lines is a run of such pairs, so all of its lines go, wherever it stands, and so does a long line
alone.  With ``chunks`` it is the exact supplement of ``line_dedup``: what either finds goes.  A run of removed lines has ``MIN_BYTES`` bytes at least, so closing brackets or "Yes." and "No." stay.  The first
occurrence of a line is in no repeated pair, so every line of the table stays at least once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import join_checked, materialise

WINDOW, DIVISOR, MIN_LINES, BASE = 2, 2, 2, 31
MIN_WORDS = 50
MIN_BYTES = 32
NEWLINE = "\n"


def line_hash(line):
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def is_long(line, min_words: int):
    return line.rlike(rf"^[ \t\r]*+(?:[^ \t\r]++[ \t\r]++){{{min_words - 1}}}[^ \t\r]")


def chunked(docs: DataFrame, window: int, divisor: int, min_words: int) -> DataFrame:
    """Adds ``_lines`` and ``_ends`` (indices of the lines that end a chunk) to rows with a ``text`` column."""
    rows = docs.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), NEWLINE, -1))
    rows = rows.withColumn("_marks", F.transform("_lines", lambda x: F.struct(
        line_hash(x).alias("hash"), (F.trim(x) != "").alias("filled"), is_long(x, min_words).alias("long"))))

    def ends(mark, i):
        roll = F.lit(0).cast("long")
        for back in range(window):
            term = F.element_at("_marks", F.greatest(i + 1 - back, F.lit(1)))["hash"] * F.lit(BASE ** back)
            roll = roll + F.when(i >= back, term).otherwise(F.lit(0))
        last = i == F.size("_marks") - 1
        before_long = F.coalesce(F.get("_marks", i + 1)["long"], F.lit(False))
        return F.when(last | (mark["filled"] & ((roll % divisor == 0) | mark["long"] | before_long)), i)

    marks = F.filter(F.transform("_marks", ends), lambda x: x.isNotNull())
    return rows.withColumn("_ends", marks).drop("_marks")


def bodies(rows: DataFrame, min_words: int) -> DataFrame:
    """Adds ``_chunks``: text, first line, lines, non-blank lines and whether there is a long one, of every chunk."""
    def chunk(end, k):
        start = F.when(k == 0, F.lit(0)).otherwise(F.element_at("_ends", F.greatest(k, F.lit(1))) + 1)
        part = F.slice("_lines", start + 1, end - start + 1)
        return F.struct(F.array_join(part, NEWLINE).alias("body"), start.alias("line"), (end - start + 1).alias("lines"),
                        F.size(F.filter(part, lambda x: F.trim(x) != "")).alias("filled"),
                        F.exists(part, lambda x: is_long(x, min_words)).alias("long"))

    return rows.withColumn("_chunks", F.transform("_ends", chunk)).drop("_lines", "_ends")


def repeated_runs(rows: DataFrame, min_lines: int, min_bytes: int) -> DataFrame:
    """(doc_id, text_key, runs) per document that loses chunks, a run as first and last chunk (start, stop) and first and last
    line.  ``rows`` have ``_chunks``."""
    # every text has a chunk; the outer form keeps the optimizer from testing that by computing all chunks beforehand
    each = rows.select("doc_id", "text_key", F.posexplode_outer("_chunks").alias("pos", "c"))
    size = ["filled", "long", "bytes", "line", "last_line"]
    each = each.select("doc_id", "text_key", "pos", "c.body", F.md5("c.body").alias("digest"), "c.filled", "c.long",
                       (F.octet_length("c.body") + 1).cast("long").alias("bytes"), "c.line", (F.col("c.line") + F.col("c.lines") - 1).alias("last_line"))
    same = later_copies(each.where("filled > 0")).select("doc_id", "text_key", "pos", *size)
    same = same.unionByName(each.where("filled = 0").select("doc_id", "text_key", "pos", *size))
    # rows that repeat doc_id and text have the same chunks
    once = same.groupBy("doc_id", "text_key", "pos").agg(*[F.first(c).alias(c) for c in size])
    doc = Window.partitionBy("doc_id", "text_key")  # at most the chunks of one text
    runs = once.withColumn("_run", F.col("pos") - F.row_number().over(doc.orderBy("pos"))).groupBy("doc_id", "text_key", "_run").agg(
        F.min("pos").alias("start"), F.max("pos").alias("stop"), F.sum("filled").alias("filled"), F.max("long").alias("long"), F.sum("bytes").alias("bytes"),
        F.min("line").alias("line"), F.max("last_line").alias("last_line"))
    runs = runs.where(((F.col("filled") >= min_lines) | F.col("long")) & (F.col("bytes") >= min_bytes))
    return materialise(runs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "stop", "line", "last_line")).alias("runs")), "line-removed")


def later_copies(each: DataFrame) -> DataFrame:
    """Rows of ``each`` (doc_id, text_key, pos, body, digest) whose body is that of the first with their digest."""
    place = F.struct("doc_id", "pos", "text_key")
    # digests only; each task sends one row per digest it meets
    groups = each.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    groups = materialise(groups.select("digest", "first"), "line-groups")
    hits = join_checked(each, groups, "digest", row_bytes=128).withColumn("is_first", place == F.col("first"))
    hits = materialise(hits.select(*each.columns, "is_first"), "line-hits")
    firsts = hits.where("is_first").select("digest", F.col("body").alias("first_body")).dropDuplicates(["digest"])
    return hits.where("not is_first").join(materialise(firsts, "line-firsts"), "digest").where(F.col("body") == F.col("first_body"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
               divisor: int = DIVISOR, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES,
               out_col: str = "line_dedup") -> DataFrame:
    """All columns of ``docs``, the text without runs of repeated chunks, and the struct ``out_col`` (n_lines,
    n_removed_lines, n_removed_chunks), which takes the place of a column of that name."""
    keyed = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("text_key"))
    gone = repeated_runs(bodies(chunked(keyed.drop("_row"), window, divisor, min_words), min_words), min_lines, min_bytes)
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "runs")
    # a row is as long as its array, so the bound is on all runs together
    row, places = gone.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    is_small = row * 64 + places * 32 <= common.BROADCAST_ROWS * 64
    rows = keyed.join(F.broadcast(gone) if is_small else gone.hint("merge"),
                      F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")
    # only texts that lose something are cut again
    cut = bodies(chunked(rows.where("runs is not null"), window, divisor, min_words), min_words)
    in_run = lambda i: F.exists("runs", lambda r: (r["start"] <= i) & (i <= r["stop"]))
    removed = F.filter("_chunks", lambda c, i: in_run(i))
    total = lambda a: F.aggregate(a, F.lit(0), lambda n, c: n + c["lines"])
    cut = cut.select("_row", F.array_join(F.transform(F.filter("_chunks", lambda c, i: ~in_run(i)),
                                                      lambda c: c["body"]), NEWLINE).alias("_text"),
                     F.struct(total("_chunks").alias("n_lines"), total(removed).alias("n_removed_lines"),
                              F.size(removed).alias("n_removed_chunks")).alias("_report"))
    whole = rows.where("runs is null").select("_row", F.col("text").alias("_text"), F.struct(
        F.size(F.split(F.coalesce("text", F.lit("")), NEWLINE, -1)).alias("n_lines"), F.lit(0).alias("n_removed_lines"),
        F.lit(0).alias("n_removed_chunks")).alias("_report"))
    out = whole.unionByName(cut)
    return out.select(*[(F.col("_text") if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns if c != out_col],
                      F.col("_report").alias(out_col))


def passages(rows: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, pos, stop, body, digest): every two successive non-blank lines, every line of ``min_words``."""
    rows = rows.select("doc_id", "text_key", F.split(F.coalesce("text", F.lit("")), NEWLINE, -1).alias("_lines"))
    filled = F.filter(F.transform("_lines", lambda x, i: F.when(F.trim(x) != "", i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_filled", filled)

    def unit(start, stop, body):
        return F.struct(start.alias("pos"), stop.alias("stop"), body.alias("body"))

    def pair(start, k):
        stop = F.get("_filled", k + 1)
        return F.when(stop.isNotNull(), unit(start, stop, F.array_join(F.slice("_lines", start + 1, stop - start + 1), NEWLINE)))

    long = F.transform("_lines", lambda x, i: F.when(x.rlike(rf"^\s*+(?:\S++\s++){{{min_words - 1}}}\S"), unit(i, i, x)))
    units = F.concat(F.transform("_filled", pair), long)
    return rows.select("doc_id", "text_key", F.explode(units).alias("c")).where("c is not null") \
        .select("doc_id", "text_key", "c.pos", "c.stop", "c.body", F.md5("c.body").alias("digest"))


def large_runs(gone: str, lines: str, min_bytes: int):
    """Of the line numbers in ``gone`` those in runs of ``min_bytes`` or more (line ends included); null if none is left."""
    none = F.array().cast("array<int>")
    kept = lambda acc: F.when(acc["size"] >= min_bytes, F.concat(acc["done"], acc["run"])).otherwise(acc["done"])

    def step(acc, i):
        n = F.octet_length(F.get(lines, i)).cast("long") + 1
        on = F.get(acc["run"], F.size(acc["run"]) - 1) == i - 1
        more = F.struct(acc["done"].alias("done"), F.concat(acc["run"], F.array(i)).alias("run"), (acc["size"] + n).alias("size"))
        return F.when(on, more).otherwise(F.struct(kept(acc).alias("done"), F.array(i).alias("run"), n.alias("size")))

    start = F.struct(none.alias("done"), none.alias("run"), F.lit(0).cast("long").alias("size"))
    left = F.aggregate(F.array_sort(gone), start, step, kept)
    return F.when(F.size(left) > 0, left)


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  min_bytes: int = MIN_BYTES, out_col: str = "line_dedup", chunks: bool = False, window: int = WINDOW,
                  divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """All columns of ``docs``, the text without repeated passages, and the struct ``out_col`` (n_lines, n_removed_lines,
    n_removed_runs), which takes the place of a column of that name.

    With ``chunks`` the runs of repeated chunks that ``line_dedup`` removes go as well.  Both are judged on the whole text,
    so no run is cut down to a line that the pairs no longer tell."""
    keyed = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("text_key"))
    same = later_copies(passages(keyed.drop("_row"), min_words))
    same = same.select("doc_id", "text_key", F.explode(F.sequence("pos", "stop")).alias("line"))
    if chunks:
        runs = repeated_runs(bodies(chunked(keyed.drop("_row"), window, divisor, min_words), min_words), min_lines, min_bytes)
        runs = runs.select("doc_id", "text_key", F.inline("runs"))
        same = same.unionByName(runs.select("doc_id", "text_key", F.explode(F.sequence("line", "last_line")).alias("line")))
    gone = materialise(same.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("gone")), "line-removed")
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "gone")
    # removed lines grow with the documents, so this is a shuffled join at every size
    rows = keyed.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")
    rows = rows.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), NEWLINE, -1)).withColumn("gone", large_runs("gone", "_lines", min_bytes))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at("_lines", i + 1)), NEWLINE))
    size = lambda a: F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size(a))
    report = F.struct(F.size("_lines").alias("n_lines"), size("gone").alias("n_removed_lines"),
                      size(F.array_except("gone", F.transform("gone", lambda i: i + 1))).alias("n_removed_runs"))
    return rows.select(*[(text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns if c != out_col],
                       report.alias(out_col))
