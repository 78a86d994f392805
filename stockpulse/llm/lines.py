"""Line dedup by a fixed-depth log-template tree.

The tree's path of a line is its number of tokens and its first ``DEPTH``
tokens; a token with a digit is a variable field, ``<*>``, from the start. In
a leaf, a position whose token is the same in over half of the leaf's
different lines is constant, any other position is a variable field. If at
least ``SIMILARITY`` of the positions are constant, the leaf's lines that
agree with that share of them have the leaf's template; every other line is
its own template (with its variable fields masked). A line without any
constant token ("12 7 3"), and one of fewer than ``MIN_TOKENS`` tokens but
``MIN_CHARS`` characters (scripts without blanks), is a template as it stands;
shorter ones are too short to be told from chance and stay. A template found
in ``MIN_DOCS`` or more different documents recurs: its lines are dropped from
every document but the first (least doc_id, nulls first) that has it.
Documents are those that differ in doc_id or text.

All steps are DataFrame operations; texts are shuffled once, to meet the
numbers of their lines to be dropped. Counting goes over hashes with
map-side combination, so a line that a third of all documents share is one
row for each task. Tokens are needed of leaves with several kinds of line
only: a broadcast bitmap of fixed size (``BITS``) tells most other lines
before any shuffle, the join with the leaves themselves the rest.

Results for odd input: null texts stay null and empty texts empty; repeated
rows get equal results and count as one document; extra columns are left out
(or kept, in ``drop_recurring_lines``); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import free_name, written

DEPTH, SIMILARITY, MIN_DOCS, MIN_TOKENS, MIN_CHARS = 4, 0.7, 2, 3, 20
#: Words of 64 bits in the bitmap of leaves (2 MB of bits).
BITS = 1 << 18


def _tokens(line: Column) -> Column:
    # with blanks of one kind the split needs no regular expression
    line = F.when(line.rlike("[\\t\\r\\f\\x0B]"), F.regexp_replace(line, "[\\t\\r\\f\\x0B]", " ")).otherwise(line)
    return F.array_remove(F.split(line, " "), "")


def _cells(leaf: Column) -> tuple[Column, Column]:
    """A leaf's word of the bitmap and its bit there."""
    return F.pmod(leaf, F.lit(BITS).cast("long")), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(leaf, 24), F.lit(64).cast("long")).cast("int"))


def line_templates(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h, line_no, template) of every line that can have a template."""
    # the columns of a line are made before it is cut further, or each of its parts would make them again
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.split(F.col("text").cast("string"), "\n").alias("lines"))
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", "[^ \\t\\r\\f\\x0B0-9]*+[0-9][^ \\t\\r\\f\\x0B]*", "<*>")).otherwise(F.col("line"))
    cut = whole.select("doc_id", "h", F.posexplode("lines").alias("line_no", "line")) \
        .select("doc_id", "h", "line_no", "line", masked.alias("masked")).select("doc_id", "h", "line_no", "line", _tokens(F.col("masked")).alias("t"))
    named = cut.select("doc_id", "h", "line_no", "line", F.size("t").alias("n"), F.exists("t", lambda x: x != "<*>").alias("constant"),
                       F.array_join(F.slice("t", 1, depth), " ").alias("path"), F.array_join("t", " ").alias("whole"))
    known = (F.col("n") >= min_tokens) & F.col("constant")
    deep = known & (F.col("n") > depth)
    exact = F.array_join(_tokens(F.col("line")), " ")
    stands = (F.col("n") > 0) & ((F.col("n") >= min_tokens) | (F.char_length(exact) >= min_chars))
    found = named.select("doc_id", "h", "line_no", "n", F.when(deep, F.xxhash64("n", "path")).alias("leaf"),
                         F.when(known, F.xxhash64("whole")).when(stands, F.xxhash64(F.lit("="), exact)).alias("sig"), F.when(deep, F.col("whole")).alias("line"))
    # the few lines without a signature are left out as they are read; a filter before would cut every line once more
    occurrences = written(found, "line-signatures", compression="zstd").where("sig is not null")
    # leaves with more than one kind of line, whose lines are longer than the path
    deep = occurrences.where("leaf is not null")
    kinds = deep.groupBy("leaf", "sig").agg(F.min("n").alias("n"))
    forked = written(kinds.groupBy("leaf").agg(F.count("*").alias("kinds")).where("kinds > 1"), "line-leaves")
    cell, bit = _cells(F.col("leaf"))
    bitmap = forked.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits"))  # BITS rows at most
    # without a leaf, or one that the bitmap lacks: a line's signature is its template
    told = occurrences.withColumn("cell", cell).join(F.broadcast(bitmap), "cell", "left") \
        .withColumn("near", F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False)))
    near = told.where("near")
    shown = near.groupBy("leaf", "sig").agg(F.min("line").alias("line")).join(forked, "leaf")
    at = shown.select("leaf", "sig", "kinds", F.split("line", " ").alias("t")).select("leaf", "sig", "kinds", "t", F.size("t").alias("n")) \
        .select("leaf", "sig", "kinds", "n", F.posexplode("t").alias("p", "tok")).withColumn("tok", F.xxhash64("tok"))
    at = written(at, "line-positions", compression="zstd")
    constant = at.groupBy("leaf", "kinds", "n", "p", "tok").agg(F.count("*").alias("c")).where("2 * c > kinds")
    sound = constant.groupBy("leaf", "n").agg(F.count("*").alias("constants")).where(F.col("constants") >= F.lit(similarity) * F.col("n")).select("leaf")
    firm = constant.join(sound, "leaf", "left_semi").select("leaf", "p", "tok")
    agree = at.select("leaf", "sig", "n", "p", "tok").join(firm, ["leaf", "p", "tok"]) \
        .groupBy("leaf", "sig", "n").agg(F.count("*").alias("same")).where(F.col("same") >= F.lit(similarity) * F.col("n")) \
        .select("sig", F.col("leaf").alias("template"))
    own = near.select("doc_id", "h", "line_no", "sig").join(agree, "sig", "left").select("doc_id", "h", "line_no", F.coalesce("template", "sig").alias("template"))
    return told.where("not near").select("doc_id", "h", "line_no", F.col("sig").alias("template")).union(own)


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, **tree) -> DataFrame:
    """(doc_id, h, drop): the numbers of the lines to be dropped, for documents that have any."""
    found = written(line_templates(docs, **tree), "line-templates", compression="zstd")
    doc = F.struct("doc_id", "h")
    if min_docs == 2:  # two documents at least: the first is not the last
        spread = found.groupBy("template").agg(F.min(doc).alias("first"), F.max(doc).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    else:
        each = found.groupBy("template", "doc_id", "h").agg(F.lit(1).alias("one"))
        spread = each.groupBy("template").agg(F.count("*").alias("n_docs"), F.min(doc).alias("first")).where(F.col("n_docs") >= min_docs)
    late = found.join(spread.select("template", "first"), "template").where(~doc.eqNullSafe(F.col("first")))
    return late.groupBy("doc_id", "h").agg(F.collect_set("line_no").alias("drop"))


def drop_recurring_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the recurring lines gone from ``text`` and ``n_dropped``, ``n_lines`` added.

    The added columns take the place of any columns of those names.
    """
    plain = docs.drop("n_dropped", "n_lines")
    own = [free_name(plain, x) for x in ("drop_id", "drop_h", "drop_n", "drop_flags")]
    # one byte for each line up to the last dropped one: '1' stays, '0' goes
    flags = F.array_join(F.transform("drop", lambda d, j: F.concat(
        F.repeat(F.lit("1"), F.when(j == 0, d).otherwise(d - F.get("drop", j - 1) - 1)), F.lit("0"))), "")
    drops = recurring_lines(plain, **options).select("doc_id", "h", F.array_sort("drop").alias("drop")) \
        .select(*[x.alias(n) for x, n in zip((F.col("doc_id"), F.col("h"), F.size("drop"), flags.cast("binary")), own)])
    met = plain.join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col(own[0])) & (F.xxhash64("text") == F.col(own[1])), "left")
    lines = F.split(F.col("text"), "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: (i >= F.length(own[3])) | (F.substring(own[3], i + 1, 1) != F.lit(b"0"))), "\n")
    text = F.when(F.col(own[3]).isNull(), F.col("text").cast("string")).otherwise(kept)
    return met.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in plain.columns],
                      F.coalesce(F.col(own[2]), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"))


#: DuckDB SQL for (doc_id, text, n_lines, n_dropped) of all documents.
ORACLE_SQL = r"""
WITH doc AS (SELECT doc_id, text, row_number() OVER () AS rid FROM documents),
line AS (SELECT doc_id, text, i - 1 AS line_no, string_split(text, chr(10))[i] AS line
         FROM (SELECT DISTINCT doc_id, text FROM doc WHERE text IS NOT NULL), unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
tok AS (SELECT doc_id, text, line_no, array_to_string(list_filter(regexp_split_to_array(line, '[ \t\r\f\x0B]+'), lambda x: x <> ''), ' ') AS exact, list_filter(regexp_split_to_array(
            regexp_replace(line, '[^ \t\r\f\x0B0-9]*[0-9][^ \t\r\f\x0B]*', '<*>', 'g'), '[ \t\r\f\x0B]+'), lambda x: x <> '') AS t FROM line),
occ AS (SELECT doc_id, text, line_no, len(t) AS n, known, len(t) || ' ' || array_to_string(t[1:4], ' ') AS leaf, CASE WHEN known THEN array_to_string(t, ' ') ELSE '=' || chr(10) || exact END AS sig
        FROM (SELECT *, len(t) >= 3 AND len(list_filter(t, lambda x: x <> '<*>')) > 0 AS known FROM tok) WHERE len(t) >= 3 OR (len(t) > 0 AND length(exact) >= 20)),
kinds AS (SELECT DISTINCT leaf, sig, n FROM occ WHERE n > 4 AND known),
forked AS (SELECT leaf, count(*) AS kinds FROM kinds GROUP BY leaf HAVING count(*) > 1),
places AS (SELECT leaf, sig, kinds, n, p, string_split(sig, ' ')[p] AS tok FROM kinds JOIN forked USING (leaf), unnest(range(1, n + 1)) AS u(p)),
constant AS (SELECT leaf, n, p, tok FROM places GROUP BY leaf, kinds, n, p, tok HAVING 2 * count(*) > kinds),
sound AS (SELECT leaf FROM constant GROUP BY leaf, n HAVING count(*) >= 0.7 * n),
agree AS (SELECT sig, leaf AS template FROM (SELECT leaf, sig, places.n FROM places JOIN constant USING (leaf, p, tok) GROUP BY leaf, sig, places.n HAVING count(*) >= 0.7 * places.n) JOIN sound USING (leaf)),
found AS (SELECT doc_id, text, line_no, coalesce('leaf ' || template, 'line ' || sig) AS template FROM occ LEFT JOIN agree USING (sig)),
spread AS (SELECT template, min(doc_id) AS first, count(DISTINCT doc_id) AS n_docs FROM found GROUP BY template HAVING count(DISTINCT doc_id) >= 2),
drops AS (SELECT doc_id, list(DISTINCT line_no) AS gone FROM found JOIN spread USING (template) WHERE doc_id <> first GROUP BY doc_id)
SELECT doc_id,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
       coalesce(len(gone), 0) AS n_dropped
FROM doc LEFT JOIN drops USING (doc_id)
"""
