"""SpotSigs document fingerprints, in DataFrame operations alone.

Wherever one of a fixed set of very common words (an anchor) stands, the next
``CHAIN`` content words make a signature together with it; a run of anchors
before a content word gives one for each. A document's fingerprint is the set
of its signatures (hashes). Boilerplate and navigation have few anchors, so
prose decides. A text without any signature has its words as a whole as the
only one. Likeness is the Jaccard similarity of the two sets.

``similar_pairs`` compares documents: sets are dealt to classes of set length
such that only the same or the next class can reach the threshold; within
them, two sets that reach it share one of their rarest signatures (prefix
filter), and a pair's Jaccard is worked out only if its lengths still allow
it. Equal sets are compared once, through one representative.

Results for odd input: a null text counts as empty, and empty texts are alike
(likeness 1); repeated rows get rows of their own; ties of doc_id go in order
of text; null doc_ids come first; extra columns are left out; an empty table
gives no rows; a lone document has itself as the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import written

CHAIN = 2

# Very common words of English, German, French and Spanish.
ANCHORS = (
    "the", "a", "an", "and", "of", "to", "in", "is", "it", "that", "was", "for", "on", "are", "with", "as", "be", "at", "this", "by", "or", "from",
    "der", "die", "das", "und", "den", "dem", "des", "ein", "eine", "einen", "ist", "von", "zu", "mit", "sich", "auf", "für", "nicht", "im", "auch",
    "le", "la", "les", "un", "une", "du", "de", "et", "est", "en", "que", "qui", "dans", "pour", "par", "sur", "au", "pas", "avec",
    "el", "los", "las", "una", "del", "y", "es", "se", "por", "con", "para", "su", "al", "lo", "no",
)


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of a text's signatures (array of long, never empty)."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    # one string for each content word, the anchors that stand before it leading: "the of house"
    marked = F.array_join(F.transform(words, lambda w: F.when(w.isin(*ANCHORS), w).otherwise(F.concat(w, F.lit("\n")))), " ")
    return F.transform(F.array(marked), lambda m: _chains(F.split(m, "\n ?"), m, chain))[0]


def _chains(groups: Column, whole: Column, chain: int) -> Column:
    """Signatures from the groups of anchors and content word (the last group has no content word)."""
    def made(g: Column) -> Column:
        n = F.size(g) - 1
        def of(x: Column, j: Column) -> Column:
            tail = [F.substring_index(F.get(g, j + k), " ", -1) for k in range(1, chain)]
            parts = F.split(x, " ")
            own = F.element_at(parts, -1)
            return F.when((j + chain <= n) & x.contains(" "),
                          F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda a: F.xxhash64(a, own, *tail))).otherwise(F.expr("cast(array() as array<bigint>)"))
        return F.array_sort(F.array_distinct(F.flatten(F.transform(g, of))))
    found = F.transform(F.array(groups), made)[0]
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.xxhash64(whole)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def digest(sigs: Column) -> Column:
    return F.md5(F.array_join(F.transform(sigs, lambda s: s.cast("string")), ","))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each document with the next in ascending doc_id (after the last: the first).

    Documents are dealt to ranges of doc_id and looked ahead within each; the
    last of a range gets the first of the next from a table with one row for
    each range. Texts are shuffled once.
    """
    spark = docs.sparkSession
    n = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = plain.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n)).first()[0] or []
    marks = sorted(set(marks))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(F.lit(marks) if marks else F.expr("cast(array() as array<bigint>)"), lambda m: m < F.col("doc_id"))))
    dealt = plain.withColumn("bucket", bucket)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    w = Window.partitionBy("bucket").orderBy(*order)
    looked = dealt.repartition(max(1, n // 4), "bucket").withColumn("sigs", signatures(F.col("text"))) \
        .withColumn("next_text", F.lead("text").over(w)).withColumn("next_sigs", F.lead("sigs").over(w))
    # the first document of each range
    least = dealt.groupBy("bucket").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")) \
        .select(F.col("bucket").alias("b"), F.when(F.col("nulls"), F.lit(None)).otherwise(F.col("least")).alias("least"))
    # (the ranges' least ids: a row for each range)
    first = plain.join(F.broadcast(least), F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("b").agg(F.min("text").alias("first_text"))
    line = Window.orderBy("b")
    circle = first.select(F.col("b"), F.coalesce(F.lead("first_text").over(line), F.first("first_text").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("first_text"))
    circle = circle.withColumn("first_sigs", signatures(F.col("first_text")))
    met = looked.join(circle, looked["bucket"] == circle["b"])
    return met.select("doc_id", "text", "sigs", F.coalesce("next_text", "first_text").alias("next_text"), F.coalesce("next_sigs", "first_sigs").alias("next_sigs"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and likenesses.

    The edited text has its last quarter (code points, rounded down) replaced
    by as many from the start of the next document.
    """
    near = with_next(docs)
    k = F.floor(F.char_length("text") / 4).cast("int")
    edited = near.withColumn("edited", F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"), F.substring("next_text", F.lit(1), k)))
    signed = edited.withColumn("edited_sigs", signatures(F.col("edited")))
    return signed.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                         digest(F.col("sigs")).alias("fingerprint"), digest(F.col("edited_sigs")).alias("edited_fingerprint"),
                         likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
                         F.size("sigs").cast("long").alias("n_signatures"))


def similar_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Links between different fingerprints, and the documents of each.

    (fp_a, fp_b, similarity) with fp_a < fp_b for every pair of different
    fingerprints at ``threshold`` or more, and (doc_id, fp) of every row:
    copies are not expanded into pairs.
    """
    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(F.col("text").cast("string")).alias("sigs")).withColumn("fp", digest(F.col("sigs")))
    members = written(signed, "spot-signatures")
    sets = members.groupBy("fp").agg(F.min("sigs").alias("sigs")).withColumn("n", F.size("sigs"))
    each = sets.select("fp", "n", F.explode("sigs").alias("s"))
    rarity = each.groupBy("s").agg(F.count("*").alias("df"))
    ranked = each.join(rarity, "s").groupBy("fp", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("r"))
    # rounding down keeps every set that may reach the threshold
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9).cast("int") + 1
    # lengths of two sets at the threshold differ by a factor of 1 / threshold at most: the same class or the next
    cls = F.floor(F.log(F.col("n").cast("double")) / -F.log(F.lit(threshold)) + 1e-9).cast("int")
    heads = ranked.select("fp", "n", cls.alias("cls"), F.explode(F.slice("r", 1, prefix)).alias("h")).select("fp", "n", "cls", F.col("h.s").alias("s"))
    left = heads.select(F.col("fp").alias("fp_a"), F.col("n").alias("n_a"), "s", F.explode(F.array(F.col("cls"), F.col("cls") + 1)).alias("cls"))
    right = heads.select(F.col("fp").alias("fp_b"), F.col("n").alias("n_b"), "s", "cls")
    small = F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9
    pairs = left.join(right, ["s", "cls"]).where((F.col("fp_a") != F.col("fp_b")) & small) \
        .select(F.least("fp_a", "fp_b").alias("fp_a"), F.greatest("fp_a", "fp_b").alias("fp_b")).distinct()
    a, b = sets.select(F.col("fp").alias("fp_a"), F.col("sigs").alias("a")), sets.select(F.col("fp").alias("fp_b"), F.col("sigs").alias("b"))
    scored = pairs.join(a, "fp_a").join(b, "fp_b").select("fp_a", "fp_b", likeness(F.col("a"), F.col("b")).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold), members.select("doc_id", "fp")
