"""The operators over the driver's tables, each with the same query in SQL.

The tables stand in for the domain: documents for pages of Markdown and for files,
conversations for documents (conv_id) of pages (turn), labels for what is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import flags as V
from leafmill.functions import text as X
from leafmill.operators import assembly as A
from leafmill.operators import blocks as B
from leafmill.operators import graphs as G
from leafmill.operators import html as H
from leafmill.operators import layout as L
from leafmill.operators import reports as R
from leafmill.operators import review as V2
from leafmill.operators import tikz as Z
from leafmill.schema import JSON_LABELS
from leafmill.session import dealt, ship, spread

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{d}/{name}.parquet")


LINES = """lines AS (
  SELECT doc_id, CAST(n // 4 AS INTEGER) AS page, CAST(n % 4 AS INTEGER) AS block_no, content,
         CASE WHEN n = 0 THEN 'title' WHEN contains(content, '|') THEN 'list' WHEN length(content) < 40 THEN 'caption' ELSE 'text' END AS type
  FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS n, unnest(l) AS content
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)))"""


def lines(spark, d):
    return B.line_blocks(spread(table(spark, d, "documents").select("doc_id", "text")))


@query("""
SELECT path, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY path) AS k FROM (
    SELECT 'in/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '/' || lang || '.txt' AS path,
           lang || '-' || left(sha256(text), 16) AS doc_id FROM documents)) WHERE k = 1
""")
def src02_drop_copies(spark, d):
    docs = table(spark, d, "documents")
    path = F.concat(F.lit("in/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("/"), "lang", F.lit(".txt"))
    return R.drop_copies(docs.select(path.alias("path"), X.document_id(path, F.sha2("text", 256)).alias("doc_id")))


@query("""
SELECT doc_id, coalesce(nullif(left(trim(regexp_replace(lang || ' doc: ' || source || '.v' || doc_id || ' (é)', '[^A-Za-z0-9._-]+', '_', 'g'), '_'), 60), ''), 'doc') || '-' || left(sha256(text), 16) AS name
FROM documents
""")
def src04_document_ids(spark, d):
    path = F.concat(F.lit("/data/in.d/"), "lang", F.lit(" doc: "), "source", F.lit(".v"), "doc_id", F.lit(" (é).txt"))
    return table(spark, d, "documents").select("doc_id", X.document_id(path, F.sha2("text", 256)).alias("name"))


@query("SELECT p_partkey, least(1.0, sqrt(40000000.0 / (p_retailprice * 100000))) AS scale FROM part")
def src10_cap(spark, d):
    return table(spark, d, "part").select("p_partkey", X.cap(F.col("p_retailprice") * 100000).alias("scale"))


@query("""
SELECT c.conv_id AS doc_id, c.page FROM (SELECT conv_id, unnest(range(0, max(turn) + 1)) AS page FROM conversations GROUP BY conv_id) c
ANTI JOIN (SELECT conv_id, turn AS page FROM conversations WHERE role = 'user') u ON c.conv_id = u.conv_id AND c.page = u.page
""")
def src13_missing_pages(spark, d):
    turns = table(spark, d, "conversations")
    docs = turns.groupBy(F.col("conv_id").alias("doc_id")).agg((F.max("turn") + 1).alias("n_pages"))
    return R.missing_pages(docs, turns.where("role = 'user'").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page")))


@query("""
SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'seen: ' || text ELSE text END AS text,
       CASE WHEN role = 'assistant' THEN 'review' ELSE 'read' END AS stage FROM conversations
""")
def src15_latest_pages(spark, d):
    read = table(spark, d, "conversations").select("conv_id", "turn", "text")
    review = table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", F.concat(F.lit("seen: "), "text").alias("text"))
    return R.latest_pages(read, review, ["conv_id", "turn"], ["text"])


@query("""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN 'b' || text ELSE 'kept ' END AS answer FROM documents
""")
def snk08_strip_thinking(spark, d):
    k = F.pmod("doc_id", F.lit(3))
    reply = F.when(k == 0, F.concat(F.lit("<think>some\nthought</think> \n"), "text")).when(k == 1, F.concat(F.lit("a</think>\n b"), "text")).otherwise(F.concat(F.lit("kept <think>"), "text"))
    return table(spark, d, "documents").select("doc_id", X.strip_thinking(reply).alias("answer"))


@query("SELECT doc_id, 'data:image/png;base64,' || base64(encode(text)) AS url FROM documents")
def snk09_data_url(spark, d):
    return table(spark, d, "documents").select("doc_id", X.data_url(F.col("text").cast("binary")).alias("url"))


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'title' WHEN 1 THEN 'heading' WHEN 2 THEN 'list' WHEN 3 THEN 'figure' ELSE 'other' END AS type FROM part
""")
def rdj11_labels(spark, d):
    label = F.element_at(F.array(*map(F.lit, ["Title", " Section-header", "List-item", "PICTURE", "chart"])), F.pmod("p_size", F.lit(5)) + 1)
    return table(spark, d, "part").select("p_partkey", B.labelled(label, JSON_LABELS).alias("type"))


@query("SELECT doc_id, text AS body FROM documents")
def rdm04_outer_fence(spark, d):
    k = F.pmod("doc_id", F.lit(3))
    reply = F.when(k == 0, F.concat(F.lit("```markdown\n"), "text", F.lit("\n```"))).when(k == 1, F.concat(F.lit("```\n"), "text")).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", X.outer_fence(reply).alias("body"))


@query(r"""
WITH l AS (SELECT doc_id, generate_subscripts(x, 1) AS n, unnest(x) AS line FROM (SELECT doc_id, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS x FROM documents)),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS s, CASE WHEN trim(line, ' ' || chr(9) || chr(13)) = '' THEN 'blank' WHEN regexp_matches(trim(line, ' ' || chr(9) || chr(13)), '^#{1,6}\s+') THEN 'heading' ELSE 'text' END AS kind FROM l),
r AS (SELECT *, sum(CASE WHEN kind = 'text' AND before = 'text' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY n) AS run FROM (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY n) AS before FROM k)),
b AS (SELECT doc_id, run, any_value(kind) AS kind, trim(string_agg(line, chr(10) ORDER BY n), ' ' || chr(10) || chr(9) || chr(13)) AS c FROM r WHERE kind <> 'blank' GROUP BY doc_id, run)
SELECT doc_id, 0 AS page, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS INTEGER) AS block_no,
  CASE WHEN kind = 'heading' THEN CASE WHEN starts_with(c, '##') THEN 'heading' ELSE 'title' END WHEN starts_with(c, '|') THEN 'table' WHEN regexp_matches(c, '^([-*+]|\d+[.)])\s') THEN 'list' ELSE 'text' END AS type,
  CASE WHEN kind = 'heading' THEN regexp_replace(regexp_replace(c, '^#{1,6}\s+', ''), '\s*#*$', '') ELSE c END AS content,
  CASE WHEN kind = 'heading' AND starts_with(c, '##') THEN CAST(length(regexp_extract(c, '^#+')) - 1 AS INTEGER) END AS level FROM b
""".replace("\\\\", "\\"))
def rdm01_markdown_blocks(spark, d):
    docs = table(spark, d, "documents")
    return B.markdown_blocks(docs.select("doc_id", F.lit(0).alias("page"), "text", F.lit(False).alias("cut"))).drop("note")


@query("""
WITH t AS (SELECT *, count(*) OVER (PARTITION BY conv_id, role, text) AS n FROM conversations)
SELECT conv_id AS doc_id, 0 AS page, CAST(min(turn) AS INTEGER) AS pos, CAST(count(*) AS INTEGER) AS copies
FROM t GROUP BY conv_id, CASE WHEN n >= 5 AND text <> '' THEN role || md5(text) ELSE 't' || turn END
""")
def rdb01_drop_repeats(spark, d):
    """Turns of a conversation by role and text, as elements of a page."""
    turns = table(spark, d, "conversations")
    return B.drop_repeats(turns.select(F.col("conv_id").alias("doc_id"), F.lit(0).alias("page"), F.col("turn").cast("int").alias("pos"), F.lit(None).cast("array<double>").alias("box"), F.col("role").alias("label"), "text"))


READ = """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount > 0.03 THEN ['truncated'] WHEN l_tax > 0.06 THEN ['repetition'] ELSE [] END AS f,
  CASE WHEN l_quantity > 25 THEN 2 ELSE 0 END AS r, CAST(l_quantity AS BIGINT) AS n FROM lineitem"""


def readings(spark, d):
    flags = F.when(F.col("l_discount") > 0.03, F.array(F.lit("truncated"))).when(F.col("l_tax") > 0.06, F.array(F.lit("repetition"))).otherwise(F.array().cast("array<string>"))
    side = lambda x: F.array(F.lit(0.0), F.lit(0.0), x, F.lit(0.5))
    return table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("attempt"), flags.alias("flags"), F.when(F.col("l_quantity") > 25, 2).otherwise(0).alias("repeated"),
        F.repeat(F.lit("x"), F.col("l_quantity").cast("int")).alias("content"), side(F.col("l_quantity") / 50).alias("bbox"),
    )


LOSS = f"""SELECT l_orderkey, l_linenumber AS attempt,
  round(sum(CASE WHEN gone THEN n / 50 * 0.5 ELSE 0.0 END), 6) AS lost,
  CAST(count(*) FILTER (r >= 2) AS BIGINT) AS repeated,
  CAST(sum(CASE WHEN gone THEN 0 ELSE n END) AS BIGINT) AS kept_chars
FROM (SELECT *, f = ['truncated'] OR (f = ['repetition'] AND r < 2) AS gone FROM ({READ})) GROUP BY l_orderkey, l_linenumber"""


@query(LOSS)
def rdb03_reading_loss(spark, d):
    return B.reading_loss(readings(spark, d), ["l_orderkey", "attempt"])


@query(f"""
WITH loss AS ({LOSS}), f AS (SELECT l_orderkey, min(attempt) FILTER (lost = 0 AND repeated = 0) AS first FROM loss GROUP BY l_orderkey),
t AS (SELECT loss.* FROM loss JOIN f USING (l_orderkey) WHERE first IS NULL OR attempt <= first)
SELECT l_orderkey, attempt, attempts_made FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY lost, repeated, -kept_chars, attempt) AS k, count(*) OVER (PARTITION BY l_orderkey) AS attempts_made FROM t) WHERE k = 1
""")
def rdb06_best_attempt(spark, d):
    return B.best_attempt(B.reading_loss(readings(spark, d), ["l_orderkey", "attempt"]), ["l_orderkey"])


@query("""
WITH s AS (SELECT p_partkey, p_size * 37 AS h, p_partkey % 3000 + 20 AS w FROM part),
r AS (SELECT *, greatest(28, 28 * round_even(h / 28, 0)) AS h0, greatest(28, 28 * round_even(w / 28, 0)) AS w0,
  sqrt(h * w / 1003520) AS big, sqrt(3136.0 / (h * w)) AS small FROM s)
SELECT p_partkey,
  CAST(CASE WHEN h0 * w0 > 1003520 THEN greatest(28, floor(h / big / 28) * 28) WHEN h0 * w0 < 3136 THEN ceil(h * small / 28) * 28 ELSE h0 END AS INTEGER) AS h,
  CAST(CASE WHEN h0 * w0 > 1003520 THEN greatest(28, floor(w / big / 28) * 28) WHEN h0 * w0 < 3136 THEN ceil(w * small / 28) * 28 ELSE w0 END AS INTEGER) AS w FROM r
""")
def rdb04_resize(spark, d):
    return table(spark, d, "part").select("p_partkey", X.resized(F.col("p_size") * 37, F.pmod("p_partkey", F.lit(3000)) + 20).alias("s")).select("p_partkey", "s.h", "s.w")


@query("""
SELECT * FROM (SELECT l_orderkey, l_linenumber, least(1.0, l_quantity / 40) AS x0, least(1.0, l_partkey % 100 / 90) AS y0 FROM lineitem) WHERE x0 < 1 AND y0 < 1
""")
def rdb05_pixel_box(spark, d):
    box = F.array(F.lit(41.0), F.pmod("l_partkey", F.lit(100)).cast("double"), F.col("l_quantity"), F.lit(95.0))
    out = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.pixel_box(box, F.lit(40), F.lit(90)).alias("b"))
    return out.where("b IS NOT NULL").select("l_orderkey", "l_linenumber", F.get("b", F.lit(0)).alias("x0"), F.get("b", F.lit(1)).alias("y0"))


@query(f"""
WITH {LINES}, c AS (SELECT *, replace(replace(content, '\\$', ''), '$$', '') AS bare FROM lines)
SELECT doc_id, count(*) AS n_blocks, count(*) FILTER (trim(content) = '') AS n_empty,
       count(*) FILTER ((length(bare) - length(replace(bare, '$', ''))) % 2 = 1) AS n_odd_math FROM c GROUP BY doc_id
""")
def val13_math_pairing(spark, d):
    return lines(spark, d).groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.count_if(F.trim("content") == "").alias("n_empty"), F.count_if(V.odd_dollars(F.col("content"))).alias("n_odd_math"))


@query(r"""
WITH t AS (SELECT doc_id, length(text) AS n_chars, list_filter(regexp_split_to_array(text, '[\s\x{00A0}\x{0085}\x{2028}\x{2029}]+'), lambda x: x <> '') AS t FROM documents)
SELECT doc_id, n_chars >= 200 AND len(t) >= 6 AND coalesce(list_bool_or(list_transform(range(1, least(60, len(t) // 6) + 1), lambda p: t[len(t) - 6 * p + 1:len(t) - p] = t[len(t) - 5 * p + 1:len(t)])), false) AS loops FROM t
""")
def val03_tail_loops(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", V.tail_loop(F.col("text")).alias("loops"))


@query()
def val01_block_flags(spark, d):
    b = lines(spark, d)
    return b.select("doc_id", "page", "block_no", "type", F.array_join(V.block_flags(F.col("type"), F.col("content")), ",").alias("flags"))


@query(rf"""
WITH {LINES}, c AS (SELECT *, list_transform(regexp_extract_all(content, '\$\$(.+?)\$\$', 1), lambda x: contains(x, '$')) AS shown, regexp_replace(content, '\$\$.+?\$\$', ' ', 'g') AS rest FROM lines),
t AS (SELECT *, (length(replace(rest, '$$', '')) - length(replace(replace(rest, '$$', ''), '$', ''))) % 2 = 1 OR regexp_matches(rest, '(^|\s)\$\$') OR regexp_matches(rest, '(^|[^\\$])\$\$(\s|$)') AS torn FROM c)
SELECT doc_id, page, block_no, concat_ws(',', CASE WHEN trim(content) = '' THEN 'empty' END, CASE WHEN torn THEN 'inline_math' END, CASE WHEN list_contains(shown, true) THEN 'latex_delims' END) AS flags FROM t
""".replace("\\\\", "\\"))
def val01_structure_flags(spark, d):
    """VAL-01 over the lines of all documents; what depends on compression is left out, and the
    lines hold no LaTeX beyond their dollar signs."""
    b = lines(spark, d)
    found = F.array_except(V.block_flags(F.col("type"), F.col("content")), F.array(F.lit("repetition")))
    return b.select("doc_id", "page", "block_no", F.array_join(found, ",").alias("flags"))


@query("SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def join01_work_left(spark, d):
    return R.work_left(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id, lang FROM documents SEMI JOIN labels USING (doc_id)")
def join02_ready(spark, d):
    return R.ready(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])


@query("""
SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'with failed pages' WHEN l.doc_id IS NOT NULL THEN 'done' WHEN d.doc_id IN (SELECT item_id FROM benchmark) THEN 'failed' ELSE 'todo' END AS status
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def join04_document_status(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return R.document_status(docs, table(spark, d, "labels").select("doc_id", (1 - F.col("quality")).alias("failed_pages")), table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")))


FIGURES = """b AS (SELECT doc_id, page, block_no, content, CASE WHEN length(content) % 11 = 0 THEN 'figure' ELSE type END AS type FROM lines)"""


@query(f"""
WITH {LINES}, {FIGURES}, n AS (SELECT *, CASE WHEN type = 'caption' THEN content END AS t FROM b)
SELECT doc_id, page, block_no, caption FROM (
  SELECT doc_id, page, block_no, type, trim(coalesce(lead(t, 1) OVER w, lead(t, 2) OVER w, lag(t, 1) OVER w, lag(t, 2) OVER w, '')) AS caption
  FROM n WINDOW w AS (PARTITION BY doc_id, page ORDER BY block_no)) WHERE type = 'figure'
""")
def fig01_captions(spark, d):
    return R.captions(lines(spark, d).withColumn("type", F.when(F.length("content") % 11 == 0, "figure").otherwise(F.col("type"))))


@query("""
SELECT DISTINCT l_orderkey AS graph, id FROM (SELECT l_orderkey, unnest([l_partkey, l_suppkey]) AS id FROM lineitem) e
ANTI JOIN (SELECT l_orderkey, l_suppkey AS id FROM lineitem) n USING (l_orderkey, id)
""")
def join07_undeclared(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("graph"), F.col("l_partkey").alias("u"), F.col("l_suppkey").alias("v"))
    return R.undeclared(li.select("graph", F.col("v").alias("id")).distinct(), li)


@query(f"""
WITH {LINES}, m AS (SELECT *, replace(replace(content, '\\$', ''), '$$', '') AS bare FROM lines),
f AS (SELECT doc_id, page, type, trim(content) = '' AS e, (length(bare) - length(replace(bare, '$', ''))) % 2 = 1 AS o FROM m),
k AS (SELECT doc_id, string_agg(type || '=' || n, ',' ORDER BY type) AS block_types FROM (SELECT doc_id, type, count(*) AS n FROM f GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, count(DISTINCT page) AS n_pages, count(*) AS n_blocks, any_value(block_types) AS block_types,
  concat_ws(',', CASE WHEN bool_or(e) THEN 'empty=' || count(*) FILTER (e) END, CASE WHEN bool_or(o) THEN 'inline_math=' || count(*) FILTER (o) END) AS open_flags,
  count(*) FILTER (e OR o) AS n_flagged FROM f JOIN k USING (doc_id) GROUP BY doc_id
""")
def agg01_report(spark, d):
    """The flagship: lines as blocks, two of the validators, the per-document report."""
    flags = V.as_set(V.flag("empty", F.trim("content") == ""), V.flag("inline_math", V.odd_dollars(F.col("content"))))
    out = R.report(lines(spark, d).withColumn("flags", flags))
    shown = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return out.select("doc_id", "n_pages", "n_blocks", shown("block_types").alias("block_types"), shown("open_flags").alias("open_flags"), F.size("flagged_blocks").cast("long").alias("n_flagged"))


@query(r"""
SELECT doc_id, word, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(r, '-')) AS word FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{Nl}\p{No}]+(?:-[\p{L}\p{Nl}\p{No}]+)*')) AS r FROM documents)
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(p)), lambda i: p[i] || '-' || p[i + 1])) FROM (SELECT doc_id, string_split(unnest(regexp_extract_all(lower(text), '[\p{L}\p{Nl}\p{No}]+(?:-[\p{L}\p{Nl}\p{No}]+)*')), '-') AS p FROM documents)
) GROUP BY doc_id, word
""")
def agg02_word_counts(spark, d):
    return A.word_counts(spread(table(spark, d, "documents").select("doc_id", F.col("text").alias("content"))))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic")
def agg03_decisions(spark, d):
    return table(spark, d, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_type, bool_and(value > 5) AS complete, count(*) AS n_items FROM events GROUP BY user_id, event_type")
def agg04_completion(spark, d):
    return R.complete_pages(table(spark, d, "events"), ["user_id", "event_type"], F.col("value") > 5)


@query("""
SELECT conv_id, count(*) AS pages, count(*) FILTER (role = 'user') AS "read", count(*) FILTER (role = 'assistant') AS review FROM conversations GROUP BY conv_id
""")
def agg05_status(spark, d):
    turns = table(spark, d, "conversations")
    return R.spans(turns.select("conv_id", (F.col("role") == "user").alias("is_read"), (F.col("role") == "assistant").alias("is_reviewed")), ["conv_id"])


@query("""
SELECT shard, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang NOT IN ('en', 'de')) AS other
FROM (SELECT lang, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 5 AS INTEGER) AS shard FROM documents) GROUP BY shard
""")
def agg07_shard_tally(spark, d):
    s = R.shards(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], 5)
    return s.groupBy("shard").agg(F.count_if(F.col("lang") == "en").alias("en"), F.count_if(F.col("lang") == "de").alias("de"), F.count_if(~F.col("lang").isin("en", "de")).alias("other"))


@query(f"WITH {LINES} SELECT doc_id, type, md5(content) AS line, count(*) AS copies FROM lines GROUP BY ALL HAVING count(*) > 1")
def agg08_repeats(spark, d):
    return lines(spark, d).groupBy("doc_id", "type", F.md5("content").alias("line")).agg(F.count("*").alias("copies")).where("copies > 1")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def win01_first_of(spark, d):
    return R.first_of(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"])


@query("""
WITH r AS (SELECT o_custkey % 20 AS k, o_orderkey AS v FROM orders), g AS (SELECT k, v, v - row_number() OVER (PARTITION BY k ORDER BY v) AS g FROM r),
i AS (SELECT k, min(v) AS a, max(v) AS b FROM g GROUP BY k, g)
SELECT k, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ',' ORDER BY a) AS ranges FROM i GROUP BY k
""")
def win03_islands(spark, d):
    return R.islands(table(spark, d, "orders").select(F.pmod("o_custkey", F.lit(20)).alias("k"), F.col("o_orderkey").alias("v")), ["k"], "v")


@query("SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 7 AS INTEGER) AS shard FROM documents")
def win06_shards(spark, d):
    return R.shards(table(spark, d, "documents").select("doc_id"), ["doc_id"], 7)


@query("SELECT conv_id AS id, 'turn' AS kind FROM conversations UNION ALL SELECT doc_id, 'document' FROM documents")
def set01_union(spark, d):
    return table(spark, d, "conversations").select(F.col("conv_id").alias("id"), F.lit("turn").alias("kind")).unionByName(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind")))


@query("SELECT doc_id AS n FROM documents EXCEPT SELECT doc_id FROM labels")
def set02_difference(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("n")).subtract(table(spark, d, "labels").select("doc_id"))


@query("SELECT c_custkey AS n FROM customer INTERSECT SELECT o_custkey FROM orders")
def set03_intersection(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("n")).intersect(table(spark, d, "orders").select("o_custkey"))


@query("SELECT DISTINCT lang, source FROM documents")
def set04_distinct(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()


@query(f"""
WITH {LINES}, c AS (SELECT doc_id, page, block_no, type, trim(content) AS c FROM lines)
SELECT doc_id, page, block_no, CASE type WHEN 'title' THEN '# ' || c WHEN 'caption' THEN CASE WHEN c <> '' AND NOT starts_with(c, '*') THEN '*' || c || '*' ELSE c END ELSE c END AS markdown FROM c
""")
def asm01_render(spark, d):
    return lines(spark, d).select("doc_id", "page", "block_no", A.rendered(F.col("type"), F.col("content")).alias("markdown"))


CUT = """p AS (SELECT doc_id, page, type, content FROM (
  SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS page, 'text' AS type, unnest(w) AS content
  FROM (SELECT doc_id, [left(text, length(text) // 2), substr(text, length(text) // 2 + 1)] AS w FROM documents)))"""


def halves(spark, d):
    half = F.floor(F.length("text") / 2).cast("int")
    both = F.array(F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text")))
    return table(spark, d, "documents").select("doc_id", F.posexplode(both).alias("page", "content"), F.lit("text").alias("type"), F.lit(0).alias("block_no"))


@query(rf"""
WITH {CUT}, c AS (SELECT doc_id, page, trim(content, ' ' || chr(10) || chr(9) || chr(13)) AS c FROM p)
SELECT a.doc_id, a.page, b.page AS next_page, a.c AS left_text, b.c AS right_text,
  a.c <> '' AND NOT regexp_matches(a.c, '[.!?:;)\]"''”’]\s*$|\$\$\s*$') AND regexp_matches(b.c, '^[\p{{Ll}}ªº]') AS joins
FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.page = a.page + 1
""")
def asm06_join_candidates(spark, d):
    return A.join_candidates(halves(spark, d))


@query(rf"""
WITH {CUT}, c AS (SELECT doc_id, page, trim(content, ' ' || chr(10) || chr(9) || chr(13)) AS c FROM p),
j AS (SELECT a.doc_id, a.c AS a, b.c AS b,
  a.c <> '' AND NOT regexp_matches(a.c, '[.!?:;)\]"''”’]\s*$|\$\$\s*$') AND regexp_matches(b.c, '^[\p{{Ll}}ªº]') AS joins FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.page = 0 AND b.page = 1),
h AS (SELECT doc_id, lower(regexp_extract(a, '([\p{{L}}\p{{Nl}}\p{{No}}]+)-$', 1)) AS x, lower(regexp_extract(b, '^[\p{{L}}\p{{Nl}}\p{{No}}]+')) AS y FROM j WHERE joins AND regexp_matches(a, '\S-$')),
r AS (SELECT doc_id, string_split(unnest(regexp_extract_all(lower(c), '[\p{{L}}\p{{Nl}}\p{{No}}]+(?:-[\p{{L}}\p{{Nl}}\p{{No}}]+)*')), '-') AS p FROM c SEMI JOIN h USING (doc_id)),
w AS (SELECT doc_id, unnest(p) AS w FROM r UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(p)), lambda i: p[i] || '-' || p[i + 1])) FROM r),
k AS (SELECT h.doc_id, CASE WHEN any_value(x) = '' THEN true WHEN count(*) FILTER (w = x || '-' || y) <> count(*) FILTER (w = x || y) THEN count(*) FILTER (w = x || '-' || y) > count(*) FILTER (w = x || y)
  ELSE any_value(x) IN ('well', 'so', 'self', 'non', 'ill', 'half', 'first', 'quasi') END AS keep FROM h LEFT JOIN w USING (doc_id) GROUP BY h.doc_id),
t AS (SELECT doc_id, CASE WHEN NOT joins THEN a WHEN keep IS NULL THEN a || ' ' || b WHEN keep THEN a || b ELSE left(a, length(a) - 1) || b END AS first, CASE WHEN NOT joins THEN b END AS last FROM j LEFT JOIN k USING (doc_id))
SELECT doc_id, regexp_replace(concat_ws(chr(10) || chr(10), '<!-- page 1 -->', nullif(first, ''), '<!-- page 2 -->', nullif(last, '')) || chr(10), '\n{{3,}}', chr(10) || chr(10), 'g') AS markdown FROM t
""".replace("\\\\", "\\"))
def asm05_assemble(spark, d):
    return A.assemble(halves(spark, d))


@query()
def htm03_page_markdown(spark, d):
    return H.html_markdown(table(spark, d, "pages").select("page_id", "html")).select("page_id", "markdown")


@query()
def rdh01_page_blocks(spark, d):
    """Raw web pages as replies: the page's ad is a layout div, the rest is loose."""
    pages = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.lit(0).alias("page"), F.col("html").alias("text"))
    return H.layout_html_blocks(pages).select("doc_id", "block_no", "type", "content")


@query(f"""
WITH {LINES} SELECT doc_id, page, block_no, CASE WHEN trim(content) = '' THEN 'text' WHEN block_no = 0 THEN 'heading' ELSE 'text' END AS type,
  trim(content) AS content, CAST(block_no * 100 AS DOUBLE) / 1000 AS y0 FROM lines
""")
def rdj01_layout_blocks(spark, d):
    """Lines written as layout JSON, one reply a page, and read again."""
    b = lines(spark, d)
    label = F.when((F.col("block_no") == 0) & (F.trim("content") != ""), "Section-header").otherwise("Text")
    el = F.struct(F.array(F.lit(0), F.col("block_no") * 100, F.lit(1000), F.col("block_no") * 100 + 90).alias("bbox"), label.alias("category"), F.col("content").alias("text"))
    replies = b.groupBy("doc_id", "page").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("block_no", el.alias("e")))), lambda x: x["e"])).alias("text"))
    rows = replies.select("doc_id", "page", F.lit(0).alias("attempt"), "text", F.lit(1000).alias("width"), F.lit(1000).alias("height"))
    return L.layout_blocks(rows).select("doc_id", "page", "block_no", "type", "content", F.get("bbox", F.lit(1)).alias("y0"))


@query("""
SELECT o_orderkey AS graph, o_custkey % 7 || '>' || (o_custkey % 7 + 1) AS edges, CASE WHEN o_orderkey % 3 = 0 THEN 'tikz_undeclared' ELSE '' END AS flags FROM orders
""")
def tik01_graphs(spark, d):
    """Small drawings made from orders: two vertices, the second at times undeclared."""
    u = F.pmod("o_custkey", F.lit(7)).cast("string")
    v = (F.pmod("o_custkey", F.lit(7)) + 1).cast("string")
    node = lambda n: F.concat(F.lit("\\node ("), n, F.lit(") at (0,0) {};"))
    code = F.concat(node(u), F.when(F.pmod("o_orderkey", F.lit(3)) == 0, "").otherwise(node(v)), F.lit("\\draw[->] ("), u, F.lit(") -- ("), v, F.lit(");"))
    g = dealt(table(spark, d, "orders").select("o_orderkey", "o_custkey")).select(F.col("o_orderkey").alias("graph"), Z.graph(code).alias("g"))
    return g.select("graph", F.array_join(G.edge_set(F.col("g.nodes"), F.col("g.edges")), ",").alias("edges"), F.array_join("g.flags", ",").alias("flags"))


@query("""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'correct' WHEN 1 THEN 'fixed' WHEN 2 THEN 'unreadable' ELSE 'fixed' END AS verdict,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN trim(text, ' ' || chr(10) || chr(9) || chr(13)) WHEN 2 THEN NULL ELSE lang END AS proposal FROM documents
""")
def rev05_parse_replies(spark, d):
    k = F.pmod("doc_id", F.lit(4))
    reply = F.when(k == 0, "**VERDICT:** Correct").when(k == 1, F.concat(F.lit("VERDICT: fixed\n<text>\n"), "text", F.lit("\n</text> bye"))).when(k == 2, "verdict: unreadable").otherwise(F.concat(F.lit("so\n```md\n"), "lang", F.lit("\n```")))
    return table(spark, d, "documents").select("doc_id", V2.parsed(reply, F.lit("text")).alias("r")).select("doc_id", "r.verdict", "r.proposal")


@query(f"""
WITH {LINES} SELECT doc_id, page, block_no FROM lines
WHERE type NOT IN ('caption') AND (trim(content) = '' OR type = 'title') AND NOT (trim(content) = '' AND block_no = 1)
""")
def rev01_wanted(spark, d):
    """Titles are reviewed always, others if empty; the second block of a page has no box."""
    b = lines(spark, d).withColumns({"type": F.when(F.col("type") == "caption", "figure").otherwise(F.col("type")), "flags": F.when(F.trim("content") == "", F.array(F.lit("empty"))).otherwise(F.array().cast("array<string>")), "bbox": F.when(F.col("block_no") != 1, F.array(F.lit(0.0)))})
    return V2.wanted(b, V2.Policy(types=("title",))).select("doc_id", "page", "block_no")


@query()
def rev10_gate(spark, d):
    """Each turn of a conversation against itself with its last vowels doubled. The measure is
    quadratic in a block's length, and turns, unlike documents, are of a block's length."""
    b = dealt(table(spark, d, "conversations").select("conv_id", "turn", "text")).select("conv_id", "turn", F.lit("text").alias("type"), F.col("text").alias("content"), F.array().cast("array<string>").alias("flags"), F.regexp_replace("text", "([aeiou]) ", "$1$1 ").alias("proposal"))
    return V2.gated(b).select("conv_id", "turn", "ok", "why")
