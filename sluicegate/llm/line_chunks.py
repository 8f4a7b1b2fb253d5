"""Repeated passages by content-defined line chunks (DataFrame expressions only).

Lines are hashed, and a rolling hash over each two adjacent lines is counted over the whole table together with
the hashes of the lines. What the two lines are, and how often they stand together, decides whether a chunk ends
between them; a cut is therefore the same wherever the lines stand, and lines added before a passage move its
chunks but do not change them. A chunk ends between two lines

* that stand together at one place only: here a passage shared with other texts begins or ends;
* of which one also stands elsewhere without the other: here a shorter shared passage begins or ends;
* whose rolling hash is divisible by ``DIVISOR``, which keeps chunks of long copies short.

Lines that follow each other in a run of repeated pairs are one passage. The chunks of passages of ``MIN_WORDS``
words or more are kept at their first place (by ``doc_id``, then line) and removed elsewhere. A passage of that
size that consists of whole lines, one line or many, is found wherever it stands: the cuts inside it are the same
everywhere, and there is a cut at each of its ends.

Hashes are counted with partial aggregation. The few that are so frequent that they could make a task large (more
than one in ``HOT_PARTS``, so at most ``HOT_PARTS`` of them) are looked up by broadcast, the rest by a join. A
copy is removed only if its bytes equal those of the first place; a chunk that merely shares a hash stays. First
places are found by hash and place and written, so that Spark can split a frequent hash in the last join. All
other joins are sort merge joins at every size, so that a small table shows what a large one needs.

A null text stays null and has no lines; an empty text has one empty line. Rows that repeat both ``doc_id``
and text count as one text and get the same result. Null ids come first. Other columns pass unchanged; where the
input has a column of a new column's name, the new one gets underscores in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kept import free_names, keep

DIVISOR = 8
MIN_WORDS = 50
HOT_PARTS = 1000
MODULUS = 1_000_003
FACTOR = 31
WORD = r"[^\x20\x09-\x0D]+"
TEXT = ["id", "mark"]


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long")


def _lines(texts: DataFrame) -> DataFrame:
    return texts.withColumn("lines", F.split("text", "\n", -1))


def _hashed(texts: DataFrame) -> DataFrame:
    """Two rows per line: its hash and number of words, and (``pair``) the hash of it and the next line."""
    hashes = F.transform("lines", lambda x: F.struct(line_hash(x).alias("hash"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    lines = _lines(texts).select(*TEXT, hashes.alias("lines"))
    each = lines.select(*TEXT, F.posexplode(F.arrays_zip("lines", F.slice("lines", 2, F.size("lines")).alias("next"))).alias("line", "v"))
    own, following = F.col("v.lines"), F.col("v.next.hash")

    def row(pair: bool, hashed: Column, words: Column) -> Column:
        return F.struct(F.lit(pair).alias("pair"), hashed.alias("hash"), words.alias("words"))

    both = F.array(row(False, own["hash"], own["words"]), row(True, F.when(following.isNotNull(), F.xxhash64(own["hash"], following)), F.lit(0)))
    return each.select(*TEXT, "line", F.inline(both)).where(F.col("hash").isNotNull())


def _repeated(hashed: DataFrame) -> DataFrame:
    """``hash``, ``n`` of all lines and pairs that stand at two places or more."""
    place = F.xxhash64(*TEXT, "line")
    counted = hashed.select("hash", place.alias("place")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("a"), F.max("place").alias("b"))
    return keep(counted.where("a <> b").select("hash", "n"), "repeated")


def _counted(hashed: DataFrame) -> DataFrame:
    """One row per repeated line: ``own``, ``n`` of it, and ``n_next`` of it and the next line (null: one place)."""
    repeated = _repeated(hashed)
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = repeated.where(F.col("n") * HOT_PARTS > total).select(F.col("hash").alias("hot"), F.col("n").alias("n_hot"))
    first = hashed.join(F.broadcast(hot), F.col("hash") == F.col("hot"), "left")
    spread = F.when(F.col("hot").isNull(), F.col("hash")).otherwise(F.xxhash64(*TEXT, "line"))
    rest = repeated.where(F.col("n") * HOT_PARTS <= total).select(F.col("hash").alias("rest"), F.col("n").alias("n_rest"))
    met = (F.col("key") == F.col("rest")) & F.col("hot").isNull()
    n = F.coalesce("n_hot", "n_rest")
    found = first.withColumn("key", spread).join(rest.hint("merge"), met, "left").where(n.isNotNull())
    slim = found.select(*TEXT, "line", "pair", "hash", "words", n.alias("n"))
    mine, pair = ~F.col("pair"), F.col("pair")
    return (
        slim.repartition(*TEXT)
        .groupBy(*TEXT, "line")
        .agg(
            F.max(F.when(mine, F.col("hash"))).alias("own"),
            F.max("words").alias("words"),
            F.max(F.when(mine, F.col("n"))).alias("n"),
            F.max(F.when(pair, F.col("n"))).alias("n_next"),
        )
    )


def _spans(counted: DataFrame, divisor: int, min_words: int) -> DataFrame:
    """Per text the first line and end of each chunk of its passages of enough words."""
    order = Window.partitionBy(*TEXT).orderBy("line")
    before = {c: F.lag(c).over(order) for c in ("line", "own", "n", "n_next")}
    looked = counted.select("*", *[v.alias(f"last_{c}") for c, v in before.items()])
    begins = F.col("last_line").isNull() | (F.col("last_line") != F.col("line") - 1) | F.col("last_n_next").isNull()
    rolled = F.col("own") % MODULUS + F.col("last_own") % MODULUS * FACTOR
    cut = begins | (F.col("last_n_next") < F.greatest("last_n", "n")) | (rolled % divisor == 0)
    numbered = looked.select(*TEXT, "line", "words", F.sum(begins.cast("int")).over(order).alias("passage"), F.sum(cut.cast("int")).over(order).alias("chunk"))
    sized = numbered.withColumn("size", F.sum("words").over(Window.partitionBy(*TEXT, "passage"))).where(F.col("size") >= min_words)
    spans = sized.groupBy(*TEXT, "chunk").agg(F.struct(F.min("line").alias("start"), (F.max("line") + 1).alias("end")).alias("span"))
    return keep(spans.groupBy(*TEXT).agg(F.collect_list("span").alias("spans")), "spans")


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in TEXT})


def _same_text(prefix: str) -> Column:
    return F.col("id").eqNullSafe(F.col(f"{prefix}_id")) & (F.col("mark") == F.col(f"{prefix}_mark"))


def _removed(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Per text the chunks that stand at an earlier place with the same bytes."""
    with_spans = _lines(texts.join(_named(spans, "span").hint("merge"), _same_text("span"))).select(*TEXT, "lines", F.explode("spans").alias("span"))
    text = F.array_join(F.slice("lines", F.col("span.start") + 1, F.col("span.end") - F.col("span.start")), "\n")
    chunks = keep(with_spans.select(*TEXT, "span", text.alias("chunk")).withColumn("hash", F.xxhash64("chunk")), "chunks")
    place = F.struct(*TEXT, "span")
    firsts = chunks.groupBy("hash").agg(F.min(place).alias("first"))
    at_first = (F.col("hash") == F.col("first_hash")) & _same_text("first") & (F.col("span") == F.col("first_span"))
    named = firsts.select(F.col("hash").alias("first_hash"), *[F.col(f"first.{c}").alias(f"first_{c}") for c in (*TEXT, "span")])
    found = chunks.join(named.hint("merge"), at_first).select("hash", "chunk", place.alias("first"))
    originals = keep(found.dropDuplicates(["hash"]).withColumnRenamed("chunk", "original"), "originals")
    copies = chunks.join(originals.hint("merge"), "hash").where((F.col("chunk") == F.col("original")) & ~place.eqNullSafe(F.col("first")))
    return copies.groupBy(*TEXT).agg(F.sort_array(F.collect_set("span")).alias("gone"))


def dedup(docs: DataFrame, names: tuple[str, str] = ("n_lines", "n_removed"), divisor: int = DIVISOR, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and the lines it had and lost."""
    names = free_names(docs, *names)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))
    texts = rows.select(*TEXT, F.col("doc.text").alias("text"))
    removed = _removed(texts, _spans(_counted(_hashed(texts)), divisor, min_words))
    # The text travels once, inside ``doc``.
    marked = _lines(rows.join(_named(removed, "gone").hint("merge"), _same_text("gone"), "left").withColumn("text", F.col("doc.text")))
    # What stands between two chunks that go, and before and after them.
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda s: s["end"]))
    ends = F.concat(F.transform("gone", lambda s: s["start"]), F.array(F.size("lines")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.slice("lines", a + 1, b - a))
    final = marked.withColumn("kept_lines", F.when(F.col("gone").isNotNull(), F.flatten(pieces)).otherwise(F.col("lines")))
    n_lines = F.coalesce(F.greatest(F.size("lines"), F.lit(0)), F.lit(0)).cast("long")
    n_removed = F.coalesce(F.size("lines") - F.size("kept_lines"), F.lit(0)).cast("long")
    text = F.when(F.col("gone").isNotNull(), F.array_join("kept_lines", "\n")).otherwise(F.col("text"))
    others = [(text if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    return final.select(*others, n_lines.alias(names[0]), n_removed.alias(names[1]))
