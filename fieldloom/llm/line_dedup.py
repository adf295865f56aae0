"""Line dedup by a log-template tree, in DataFrame operations alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bitmap_blocks, bits_for, discard, join_unique, maybe_in, saved, table

#: Leading tokens that, with the number of tokens, lead to a leaf of the tree.
DEPTH = 3
#: A template that so many documents have is recurring.
MIN_DOCS = 5
#: A token is fixed at its place if so many percent of its leaf's documents have it there.
FIELD_PERCENT = 25
#: Share of a template's tokens that must be fixed, in percent.
FIXED_PERCENT = 60
#: Bits of a filter for each document; its size is bounded by shared.MAX_BITS.
BITS_PER_ROW = 256
VARIABLE = "<*>"


def with_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, masked, tokens): the lines that have words, one space between those; words with a digit are variable."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    bare = F.btrim("line", F.lit(" \t\n\x0b\x0c\r"))
    lines = lines.select("doc_id", "pos", bare.alias("line")).where("line <> ''")
    word = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", word, VARIABLE)).otherwise(F.col("line"))
    tokens = F.split(masked, r"[\x20\x09-\x0D]+")
    return lines.select("doc_id", "pos", tokens.alias("tokens")).select("doc_id", "pos", "tokens", F.array_join("tokens", " ").alias("masked"))


def leaf(tokens: Column) -> Column:
    """The tree's leaf: number of tokens and leading tokens."""
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, DEPTH))


def with_documents(lines: DataFrame, shared: DataFrame, keys: list[str], cut: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> DataFrame:
    """(keys, docs): how many documents have each of the keys that ``lines`` (leaf, line, own), as ``cut`` parts them, give to their lines.

    ``own`` counts documents with no other line in the leaf, so that these add up; ``shared`` (leaf, line, doc_id)
    has the others, which are counted once each.
    """
    several = cut(lines.join(shared, ["leaf", "line"])).select(*keys, "doc_id").distinct().select(*keys, F.lit(1).cast("long").alias("own"))
    return cut(lines).select(*keys, "own").unionByName(several).groupBy(*keys).agg(F.sum("own").alias("docs"))


def recurring_lines(hashed: DataFrame, n_docs: int, min_docs: int = MIN_DOCS, fixed_percent: int = FIXED_PERCENT, field_percent: int = FIELD_PERCENT) -> DataFrame:
    """(line, check): two hashes of the tokens of each line whose template recurs.

    Within a leaf a token behind the leading ones is fixed at its place if ``field_percent`` of the leaf's documents have
    it there, however many these are; all others are variable fields. A template recurs when ``fixed_percent`` of
    the tokens behind the leading ones are fixed, one at least, and ``min_docs`` documents have a line of it. Several
    templates may share a leaf. So lines that are left are parted once more, by their token of the most documents that
    is not fixed there but which ``min_docs`` have, and judged in these groups alike. A line recurs too that
    ``min_docs`` documents have as it is, if that many of its tokens have no digit. Documents count once each.
    ``hashed``: doc_id, leaf, line, check, masked of all lines. Leaves are counted first, so that only lines
    of leaves with enough documents, as a bounded bitmap tells, shuffle with their tokens.
    """
    bits = bits_for(n_docs, BITS_PER_ROW)
    cell = F.pmod("leaf", F.lit(bits)) + 1
    of_doc = hashed.groupBy("doc_id", "leaf").agg(F.collect_set("line").alias("lines"))
    leaves = saved(of_doc.groupBy("leaf").agg(F.count("*").alias("leaf_docs")).where(F.col("leaf_docs") >= min_docs))
    blocks = saved(bitmap_blocks(leaves.select(cell.alias("_cell")), "_cell"))
    of_doc = saved(maybe_in(of_doc, cell, blocks).where("_maybe").select("doc_id", "leaf", "lines"))
    own = of_doc.where("size(lines) = 1").groupBy("leaf", F.col("lines")[0].alias("line")).agg(F.count("*").alias("own"))
    shared = saved(of_doc.where("size(lines) > 1").select("doc_id", "leaf", F.explode("lines").alias("line")))
    distinct = maybe_in(hashed.select("leaf", "line", "check", "masked"), cell, blocks).where("_maybe").groupBy("leaf", "line", "check").agg(F.min("masked").alias("masked"), F.count("*").alias("rows"))
    distinct = saved(distinct.join(leaves, "leaf").join(own, ["leaf", "line"], "left").withColumn("own", F.coalesce("own", F.lit(0))))
    line = ["leaf", "line", "check"]
    place = ["group", "group_docs", "at", "token"]
    behind = F.slice(F.split("masked", " "), DEPTH + 1, 1 << 30)

    def with_words(lines: DataFrame) -> DataFrame:
        return lines.select("*", F.posexplode(behind).alias("at", "token")).where(F.col("token") != VARIABLE)

    def judged(lines: DataFrame, places: DataFrame) -> DataFrame:
        """Of lines (leaf, line, check, masked, own, group, group_docs): those of recurring templates. ``places``: documents of each group's words.

        A group has at most 100 / ``field_percent`` fixed tokens at each place, which meet its lines as one row of hashes.
        """
        fixed = places.where(F.col("docs") * 100 >= F.col("group_docs") * field_percent).groupBy("group").agg(F.collect_list(F.xxhash64("at", "token")).alias("fixed"))
        marks = F.transform(behind, lambda t, i: F.when(t != VARIABLE, F.xxhash64(i, t)))
        marked = lines.join(fixed, "group").select(*line, "own", "group", F.size(behind).alias("n"), F.array_intersect(F.array_compact(marks), "fixed").alias("hits"))
        wide = saved(marked.where(F.size("hits") * 100 >= F.col("n") * fixed_percent).where("size(hits) > 0").select(*line, "own", "group", F.xxhash64("hits").alias("template")))
        many = with_documents(wide, shared, ["group", "template"]).where(F.col("docs") >= min_docs)
        return wide.join(many, ["group", "template"], "left_semi").select(*line)

    tokens = F.split("masked", " ")
    longer = distinct.where(F.size(tokens) > DEPTH).select(*line, "masked", "own", F.col("leaf").alias("group"), F.col("leaf_docs").alias("group_docs"))
    is_field = F.col("docs") * 100 < F.col("group_docs") * field_percent
    places = saved(with_documents(longer, shared, place, with_words).where(~is_field | (F.col("docs") >= min_docs)))
    general = judged(longer, places)
    plain = F.size(F.filter(tokens, lambda t: t != VARIABLE)) * 100 >= F.size(tokens) * fixed_percent
    often = with_documents(distinct.select("leaf", "line", "own"), shared, ["leaf", "line"]).where(F.col("docs") >= min_docs)
    alone = distinct.where(plain).join(often, ["leaf", "line"], "left_semi").select(*line)
    found = saved(general.unionByName(alone).distinct())
    # the token that parts the lines left: a field by its share, but one that enough documents have, so its leaf has more
    parting = places.where((F.col("docs") >= min_docs) & is_field).select("group", "at", "token", "docs")
    words = with_words(longer.where(F.col("group_docs") * field_percent > min_docs * 100).join(found, line, "left_anti"))
    best = words.join(parting, ["group", "at", "token"]).groupBy(*line).agg(F.min(F.struct((-F.col("docs")).alias("d"), "at", "token")).alias("k"))
    parted = saved(longer.join(best, line).select(*line, "masked", "own", F.xxhash64("leaf", "k.at", "k.token").alias("group")))
    sizes = with_documents(parted, shared, ["group"]).where(F.col("docs") >= min_docs)
    parted = saved(parted.join(sizes.withColumnRenamed("docs", "group_docs"), "group"))
    second = judged(parted, with_documents(parted, shared, place, with_words))
    found = found.unionByName(second).select("line", "check").distinct()
    return distinct.join(found, ["line", "check"], "left_semi").groupBy("line").agg(F.min("check").alias("kind"), F.sum("rows").alias("rows"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, fixed_percent: int = FIXED_PERCENT, field_percent: int = FIELD_PERCENT) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text): each document without the lines whose template recurs across documents.

    All lines of a recurring template go, in every document. Lines are what line feeds part;
    blank ones stay. A null text counts as empty, which is one blank line. Documents without a
    dropped line pass straight through; a bounded bitmap of ids tells which may have one. Ties do not
    arise: shares and counts are compared with >=, and of tokens that as many documents have the first one parts lines. An id stands for one text; rows that repeat it count as
    one document, and each loses the lines that recur at the same places. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_docs = docs.count()
    bits = bits_for(n_docs, BITS_PER_ROW)
    hashed = saved(with_lines(docs).select("doc_id", "pos", leaf(F.col("tokens")).alias("leaf"), F.xxhash64("tokens").alias("line"), F.xxhash64(F.lit(1), "tokens").alias("check"), "masked"))
    dropped = saved(recurring_lines(hashed, n_docs, min_docs, fixed_percent, field_percent))
    line_cell, doc_cell = F.pmod("line", F.lit(bits)) + 1, F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    blocks = saved(bitmap_blocks(dropped.select(line_cell.alias("_cell")), "_cell"))
    maybe = maybe_in(hashed.select("doc_id", "pos", "line", "check"), line_cell, blocks).where("_maybe").drop("_maybe")
    total = dropped.agg(F.sum("rows")).first()[0] or 0
    found = join_unique(maybe, dropped, "line", "rows", total).where("check = kind").select("doc_id", "pos")
    hits = saved(found.groupBy("doc_id").agg(F.collect_set("pos").alias("gone")))
    discard(hashed)
    tested = maybe_in(docs, doc_cell, saved(bitmap_blocks(hits.select(doc_cell.alias("_cell")), "_cell")))
    n_lines = F.size(F.split("text", "\n")).cast("long").alias("n_lines")
    none = tested.where(~F.col("_maybe")).select("doc_id", n_lines, F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept_text"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False))), "\n")
    some = tested.where("_maybe").join(hits.hint("merge"), "doc_id", "left")
    n_gone = F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")
    return none.unionByName(some.select("doc_id", n_lines, n_gone, kept.alias("kept_text")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s),
t AS (SELECT doc_id, pos, line, list_transform(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS tokens FROM e),
k AS (SELECT doc_id, pos, line, tokens, len(tokens) AS n, array_to_string(tokens, ' ') AS masked, array_to_string(tokens[1:3], ' ') AS lead FROM t),
l AS (SELECT n, lead, count(DISTINCT doc_id) AS leaf_docs FROM k WHERE n > 0 GROUP BY n, lead),
w AS (SELECT * FROM (SELECT DISTINCT doc_id, n, lead, masked, unnest(tokens) AS token, unnest(range(n)) AS i FROM k WHERE n > 0) AS u WHERE i > 2 AND token <> '<*>'),
h AS (SELECT n, lead, i, token, leaf_docs, count(DISTINCT doc_id) AS docs FROM w JOIN l USING (n, lead) WHERE leaf_docs >= 5 GROUP BY ALL),
f AS (SELECT n, lead, i, token FROM h WHERE docs * 100 >= leaf_docs * 25),
m AS (SELECT w.doc_id, w.n, w.lead, w.masked, count(*) AS n_fixed, string_agg(CAST(i AS VARCHAR) || '=' || token, ' ' ORDER BY i) AS template FROM w JOIN f USING (n, lead, i, token) GROUP BY w.doc_id, w.n, w.lead, w.masked),
g AS (SELECT n, lead, template FROM m WHERE n_fixed * 100 >= (n - 3) * 60 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
d1 AS (SELECT DISTINCT masked FROM m JOIN g USING (n, lead, template)
       UNION SELECT masked FROM k WHERE n > 0 AND len(list_filter(tokens, lambda t: t <> '<*>')) * 100 >= n * 60 GROUP BY masked HAVING count(DISTINCT doc_id) >= 5),
b AS (SELECT masked, i AS ki, token AS kt FROM (SELECT DISTINCT n, lead, masked, i, token FROM w) JOIN h USING (n, lead, i, token)
      WHERE docs >= 5 AND docs * 100 < leaf_docs * 25 AND masked NOT IN (SELECT masked FROM d1) QUALIFY row_number() OVER (PARTITION BY masked ORDER BY docs DESC, i, token) = 1),
w1 AS (SELECT w.*, ki, kt FROM w JOIN b USING (masked)),
w2 AS (SELECT w1.*, part_docs FROM w1 JOIN (SELECT n, lead, ki, kt, count(DISTINCT doc_id) AS part_docs FROM w1 GROUP BY ALL) AS z USING (n, lead, ki, kt)),
f2 AS (SELECT n, lead, ki, kt, i, token FROM w2 WHERE part_docs >= 5 GROUP BY n, lead, ki, kt, i, token, part_docs HAVING count(DISTINCT doc_id) * 100 >= part_docs * 25),
m2 AS (SELECT w2.doc_id, w2.n, w2.lead, ki, kt, w2.masked, count(*) AS n_fixed, string_agg(CAST(i AS VARCHAR) || '=' || token, ' ' ORDER BY i) AS template FROM w2 JOIN f2 USING (n, lead, ki, kt, i, token) GROUP BY ALL),
g2 AS (SELECT n, lead, ki, kt, template FROM m2 WHERE n_fixed * 100 >= (n - 3) * 60 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT masked FROM d1 UNION SELECT masked FROM m2 JOIN g2 USING (n, lead, ki, kt, template)),
x AS (SELECT k.doc_id, k.pos, k.line, d.masked IS NOT NULL AS gone FROM k LEFT JOIN d ON k.masked = d.masked AND k.n > 0)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM x GROUP BY doc_id
"""
