"""More of the inventory over the driver's tables: names, replies, boxes, math, review and
work lists. Where the tables hold no such content, it is built from each of their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import flags as V
from leafmill.functions import text as X
from leafmill.operators import graphs as G
from leafmill.operators import reports as R
from leafmill.operators import review as V2
from leafmill.operators import tikz as Z
from leafmill.plans.queries import LINES, lines, query, table
from leafmill.schema import known_type
from leafmill.session import dealt
from leafmill.sources import files, models


def pick(of, *values):
    """One of the values by a number's remainder."""
    values = [v if not isinstance(v, str) else F.lit(v) for v in values]
    return F.element_at(F.array(*values), (F.pmod(of, F.lit(len(values))) + 1).cast("int"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS digest, 'p' || lpad(CAST(doc_id + 1 AS VARCHAR), CAST(greatest(4, length(CAST(doc_id + 1 AS VARCHAR))) AS INTEGER), '0') AS page FROM documents")
def src03_digests(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), X.page_name(F.col("doc_id")).alias("page"))


@query("SELECT doc_id FROM documents WHERE sha256(coalesce(text, '')) <> sha256(coalesce(lang, ''))")
def src12_collisions(spark, d):
    docs = table(spark, d, "documents")
    digest = lambda c: F.sha2(F.coalesce(F.col(c), F.lit("")), 256).alias("sha256")
    return files.collisions(docs.select("doc_id", digest("lang")), docs.select("doc_id", digest("text"))).select("doc_id")


@query("SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE 'seen ' || text END AS reply, CASE WHEN role = 'system' THEN 'rejected' END AS error_kind FROM conversations")
def snk07_answered(spark, d):
    """A model that says each text again and rejects requests of the system."""

    def model(request: str) -> str:
        if request.startswith("system:"):
            raise models.Rejected("no")
        return "seen " + request.partition(":")[2]

    rows = table(spark, d, "conversations").select("conv_id", "turn", F.concat_ws(":", "role", "text").alias("request"))
    return models.answered(rows, model).select("conv_id", "turn", "reply", "error_kind")


@query("SELECT doc_id, 'x' || coalesce(text, '') AS body, coalesce(lang, '') AS lang, coalesce(source, '') || ': b' AS source FROM documents")
def rdm03_front_matter(spark, d):
    none = F.lit("")
    reply = F.concat(F.lit("---\nlang:  "), F.coalesce("lang", none), F.lit(" \nsource: "), F.coalesce("source", none), F.lit(": b\n---\nx"), F.coalesce("text", none))
    m = table(spark, d, "documents").select("doc_id", X.front_matter(reply).alias("m"))
    return m.select("doc_id", "m.body", F.try_element_at("m.keys", F.lit("lang")).alias("lang"), F.try_element_at("m.keys", F.lit("source")).alias("source"))


@query("SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 90 WHEN 1 THEN 0 WHEN 2 THEN 270 ELSE 0 END AS turn FROM part")
def rdm06_rotation(spark, d):
    k = F.col("p_size")
    reply = F.concat(F.lit("---\nis_rotation_valid: "), pick(k, "False", "True", "false", "False"), F.lit("\nrotation_correction: "), pick(k, "90", "180", "270", "45"), F.lit("\n---\n"), "p_name")
    return table(spark, d, "part").select("p_partkey", X.rotation_asked(reply).alias("turn"))


@query("SELECT p_partkey, p_brand || ' $' || p_name || '$, $' || p_size || '$' AS text FROM part")
def rdm08_dollar_math(spark, d):
    reply = F.concat("p_brand", F.lit(r" \( "), "p_name", F.lit(r" \), \("), "p_size", F.lit(r"\)"))
    return table(spark, d, "part").select("p_partkey", X.dollar_math(reply).alias("text"))


@query("""
SELECT l_orderkey, l_linenumber, least(1.0, l_quantity * 30 / 1000) AS x0, CAST(1 AS DOUBLE) AS x1 FROM lineitem WHERE l_quantity * 30 < 1000
""")
def rdh09_layout_box(spark, d):
    text = F.concat_ws(" ", F.col("l_quantity") * 30, F.lit("10,"), F.lit("1200"), F.lit("900"))
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.layout_box(text).alias("b")).where("b IS NOT NULL")
    return b.select("l_orderkey", "l_linenumber", F.get("b", F.lit(0)).alias("x0"), F.get("b", F.lit(2)).alias("x1"))


@query("""
WITH RECURSIVE s AS (SELECT p_partkey, CAST(trunc(p_retailprice * 5) AS BIGINT) AS w0, CAST(p_size * 101 AS BIGINT) AS h0 FROM part),
a AS (SELECT *, CASE WHEN w0 * h0 > 6291456 THEN sqrt(6291456.0 / (w0 * h0)) WHEN w0 * h0 < 50176 THEN sqrt(50176.0 / (w0 * h0)) ELSE 1.0 END AS k FROM s),
r AS (
  SELECT p_partkey, greatest(1, CAST(round_even(w0 * k / 28, 0) AS BIGINT)) AS w, greatest(1, CAST(round_even(h0 * k / 28, 0) AS BIGINT)) AS h, w0 / h0 AS shape, 0 AS step FROM a
  UNION ALL
  SELECT p_partkey, CASE WHEN wide THEN w - 1 ELSE w END, CASE WHEN NOT wide AND h > 1 THEN h - 1 ELSE h END, shape, step + 1
  FROM (SELECT *, CASE WHEN w = 1 THEN false WHEN h = 1 THEN true ELSE abs((w - 1) / h - shape) < abs(w / (h - 1) - shape) END AS wide FROM r WHERE w * h * 784 > 6291456)
)
SELECT p_partkey, CAST(arg_max(w, step) * 28 AS INTEGER) AS w, CAST(arg_max(h, step) * 28 AS INTEGER) AS h FROM r GROUP BY p_partkey
""")
def rdh13_fitted(spark, d):
    return table(spark, d, "part").select("p_partkey", X.fitted((F.col("p_retailprice") * 5).cast("int"), F.col("p_size") * 101).alias("s")).select("p_partkey", "s.w", "s.h")


@query("""
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber = 1 THEN 0.0 ELSE least(0.8, round((l_linenumber - 1) * 0.2, 1)) END AS DOUBLE) AS temperature,
  CAST(CASE WHEN l_linenumber = 1 THEN 0.1 ELSE 0.95 END AS DOUBLE) AS top_p, 'reader:' || l_returnflag || ':' || l_linestatus AS tag FROM lineitem
""")
def rdh12_sampling(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.sampling(F.col("l_linenumber") - 1).alias("s"), X.reader_tag(F.col("l_returnflag"), F.col("l_linestatus")).alias("tag"))
    return rows.select("l_orderkey", "l_linenumber", "s.temperature", "s.top_p", "tag")


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber, l_discount AS x0, l_quantity / 50 AS x1 FROM lineitem),
p AS (SELECT *, greatest(0, CAST(trunc(x0 * 1000 - 16) AS INTEGER)) AS a, least(1000, CAST(trunc(x1 * 1000 + 16) AS INTEGER)) AS b FROM b)
SELECT l_orderkey, l_linenumber, CASE WHEN b - a < 8 THEN 0 ELSE a END AS x0, CASE WHEN b - a < 8 THEN 1000 ELSE b END AS x1 FROM p
""")
def rev04_crop_box(spark, d):
    box = F.array(F.col("l_discount"), F.lit(0.1), F.col("l_quantity") / 50, F.lit(0.9))
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.crop_box(box, F.lit(1000), F.lit(1000)).alias("b"))
    return b.select("l_orderkey", "l_linenumber", F.get("b", F.lit(0)).alias("x0"), F.get("b", F.lit(2)).alias("x1"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 4 THEN '$' || p_name ELSE p_name END AS body FROM part")
def val12_strip_math_delims(spark, d):
    k, n = F.col("p_size"), F.col("p_name")
    return table(spark, d, "part").select("p_partkey", X.strip_math_delims(F.concat(pick(k, " $$", r"\[ ", r"\(", "$ ", "$"), n, pick(k, "$$ ", r"\]", r" \)", " $", ""))).alias("body"))


@query(rf"""
WITH {LINES}, c AS (SELECT doc_id, page, block_no, regexp_extract_all(translate(content, 'ae', '{{}}'), '[{{}}]') AS b FROM lines),
u AS (SELECT doc_id, page, block_no, generate_subscripts(b, 1) AS i, unnest(b) AS ch FROM c),
s AS (SELECT *, sum(CASE ch WHEN '{{' THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id, page, block_no ORDER BY i) AS depth FROM u),
g AS (SELECT doc_id, page, block_no, min(depth) >= 0 AND arg_max(depth, i) = 0 AS ok FROM s GROUP BY ALL)
SELECT c.doc_id, c.page, c.block_no, coalesce(g.ok, true) AS ok FROM c LEFT JOIN g USING (doc_id, page, block_no)
""")
def val07_braces(spark, d):
    """Lines with braces for two of their letters."""
    return lines(spark, d).select("doc_id", "page", "block_no", V.braces_ok(F.translate("content", "ae", "{}")).alias("ok"))


@query("""
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN 'latex_braces' WHEN 2 THEN 'latex_env' WHEN 3 THEN 'latex_leftright' WHEN 4 THEN 'latex_delims' ELSE 'latex_delims,latex_env' END AS flags FROM part
""")
def val09_latex_flags(spark, d):
    """VAL-08 to VAL-11: formulas with a fault of each kind."""
    body = F.concat(F.lit(r"x_{"), "p_size", pick(F.col("p_size"), r"} \left( \begin{a}\begin{b}\end{b}\end{a} \right)", r" \{", r"} \begin{a}\end{b}", r"} \left( \leftarrow x )", r"} \$ $y$", r"} \end{a} ```"))
    return table(spark, d, "part").select("p_partkey", F.array_join(V.latex_flags(body), ",").alias("flags"))


@query("SELECT p_partkey, p_name || '   ' || p_brand || ' ' AS outside FROM part")
def val14_outside_math(spark, d):
    return table(spark, d, "part").select("p_partkey", V.outside_math(F.concat("p_name", F.lit(" $$x\ny$$ "), "p_brand", F.lit("$z_1$"))).alias("outside"))


@query("""
SELECT l_orderkey, CASE WHEN count(*) < 2 THEN 'table_parse' WHEN count(DISTINCT l_returnflag = 'R') > 1 THEN 'table_shape' ELSE '' END AS flags FROM lineitem GROUP BY l_orderkey
""")
def val16_pipe_tables(spark, d):
    """Line items of an order as a pipe table; returned ones have a cell more."""
    row = F.concat(F.lit("| "), "l_linenumber", F.lit(r" | a\|b | "), "l_quantity", F.when(F.col("l_returnflag") == "R", " | R |").otherwise(" |"))
    t = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(row)), "\n").alias("t"))
    return t.select("l_orderkey", F.array_join(V.pipe_table_flags(F.col("t")), ",").alias("flags"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'table' ELSE 'figure' END AS type FROM part")
def val18_known_types(spark, d):
    return table(spark, d, "part").select("p_partkey", known_type(pick(F.col("p_size"), "text", "table", "figure")).alias("type"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality > 0)")
def val21_to_read(spark, d):
    """Labels of the lowest quality stand for failed readings, tried again."""
    pages = table(spark, d, "documents").select("doc_id", F.lit(0).alias("page"))
    read = table(spark, d, "labels").select("doc_id", F.lit(0).alias("page"), (F.col("quality") <= 0).alias("failed"))
    return R.to_read(pages, read, retry_failed=True).select("doc_id")


@query("SELECT DISTINCT l_orderkey AS doc_id, l_linenumber AS page FROM lineitem WHERE l_returnflag = 'R' OR l_tax > 0.05")
def val24_failed_pages(spark, d):
    flags = F.when(F.col("l_returnflag") == "R", F.array(F.lit("page_failed"))).otherwise(F.array().cast("array<string>"))
    return R.failed_pages(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), (F.col("l_tax") > 0.05).alias("failed"), flags.alias("flags")))


@query(r"SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '\*' WHEN 1 THEN '\_ &lt;' WHEN 2 THEN '' ELSE '\#' END AS lost FROM part")
def rev08_dropped_escapes(spark, d):
    k, n = F.col("p_size"), F.col("p_name")
    draft = F.concat(pick(k, r"\* ", r"a\_b &lt;b ", r"\* $\_$ ", r"\# "), n)
    proposal = F.concat(pick(k, "* ", "a_b <b ", r"\* $_$ ", "# "), n)
    return dealt(table(spark, d, "part").select("p_partkey", "p_size", "p_name")).select("p_partkey", F.array_join(V2.dropped_escapes(draft, proposal), " ").alias("lost"))


@query("SELECT p_partkey, p_size % 6 < 4 AS placeholder FROM part")
def rev09_placeholder(spark, d):
    said = pick(F.col("p_size"), "...", "N/A.", "[no legible text in the crop]", "(Page intentionally left blank)", "(none of the above)", F.concat(F.lit("n/a "), "p_name"))
    return table(spark, d, "part").select("p_partkey", V2.placeholder(said).alias("placeholder"))


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'agreed' WHEN 1 THEN 'unreadable' WHEN 2 THEN 'edited' ELSE 'no-proposal' END AS reviewed,
  CASE WHEN p_size % 4 = 2 THEN p_name || '.' ELSE p_name END AS content, CASE WHEN p_size % 4 = 1 THEN 'unreadable' ELSE '' END AS flags FROM part
""")
def rev11_reviewed(spark, d):
    reply = pick(F.col("p_size"), "VERDICT: correct", "VERDICT: unreadable", F.concat(F.lit("VERDICT: fixed\n<text>"), "p_name", F.lit(".</text>")), "VERDICT: fixed")
    rows = table(spark, d, "part").select("p_partkey", F.lit("text").alias("type"), F.col("p_name").alias("content"), F.lit("reader").alias("source"), F.array().cast("array<string>").alias("flags"), reply.alias("reply"))
    return V2.reviewed(rows, "reviewer").select("p_partkey", "reviewed", "content", F.array_join("flags", ",").alias("flags"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '' ELSE 'Automatic checks flagged: empty, repeated (written more than once; this copy was kept).' END AS line FROM part")
def rev13_issues(spark, d):
    flags = F.when(F.col("p_size") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("empty"), F.lit("repeated")))
    return table(spark, d, "part").select("p_partkey", V2.issues(flags).alias("line"))


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'plot' WHEN 1 THEN 'commutative_diagram' ELSE 'other' END AS kind, p_name AS summary,
  CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type ELSE '' END AS structure FROM part
""")
def fig02_described(spark, d):
    told = F.concat(F.lit("\n<description> "), "p_name", F.lit(" </description>\n"))
    reply = pick(F.col("p_size"), F.concat(F.lit("KIND: Plot"), told, F.lit("<structure>\n"), "p_brand", F.lit("\n</structure>")), F.concat(F.lit("**KIND**: commutative diagram"), told, F.lit("```latex\n"), "p_type", F.lit("\n```")), F.concat(F.lit("KIND: map"), told, F.lit("```\n"), "p_type", F.lit("\n```")))
    return table(spark, d, "part").select("p_partkey", G.described(reply).alias("i")).select("p_partkey", "i.kind", "i.summary", "i.structure")


@query("""
SELECT o_orderkey AS graph, '2 vertices, 1 edges (directed)' || chr(10) || chr(10) || '- Vertices: a' || o_custkey || ', b' || chr(10) || '- Edges:' || chr(10) || '  - a' || o_custkey || ' → b' AS markdown FROM orders
""")
def tik11_graph_markdown(spark, d):
    code = F.concat(F.lit(r"\node (u) at (0,0) {a"), "o_custkey", F.lit(r"}; \node (v) at (1,0) {b}; \draw[->] (u) -- (v);"))
    g = dealt(table(spark, d, "orders").select("o_orderkey", "o_custkey")).select(F.col("o_orderkey").alias("graph"), Z.graph(code).alias("g"))
    return g.select("graph", G.graph_markdown(F.col("g.nodes"), F.col("g.edges")).alias("markdown"))


@query("SELECT (SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)) AS to_read, (SELECT count(*) FROM labels ANTI JOIN benchmark ON doc_id = item_id) AS to_review")
def agg06_todo(spark, d):
    page = F.lit(0).alias("page")
    read = table(spark, d, "labels").select("doc_id", page)
    return R.still_to_do(table(spark, d, "documents").select("doc_id", page), read, table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), page))


@query("SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS readers FROM documents GROUP BY lang")
def agg10_readers(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("readers"))


@query("""
SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id) UNION ALL SELECT doc_id, 'label ' || quality FROM labels
""")
def str02_upsert(spark, d):
    return R.upsert(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").select("doc_id", F.concat(F.lit("label "), "quality").alias("lang")), ["doc_id"])


@query("SELECT conv_id AS doc_id, turn AS page, role FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.conv_id AND l.quality = c.turn)")
def str03_invalidate(spark, d):
    review = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), "role")
    return R.invalidate(review, table(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("page")))


@query("""
WITH k AS (SELECT conv_id, max(turn) + 1 AS n FROM conversations GROUP BY conv_id), r AS (SELECT conv_id, count(DISTINCT turn) AS n FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT conv_id AS doc_id FROM k LEFT JOIN r USING (conv_id) WHERE coalesce(r.n, 0) < k.n AND conv_id IN (SELECT doc_id FROM labels)
""")
def str05_finished(spark, d):
    """Labels stand for outputs; turns of users for the page images and readings that are left."""
    turns = table(spark, d, "conversations")
    docs = turns.groupBy(F.col("conv_id").alias("doc_id")).agg((F.max("turn") + 1).alias("n_pages"))
    left = turns.where("role = 'user'").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"))
    return R.finished(docs, table(spark, d, "labels").select("doc_id", F.lit(0).alias("failed_pages")), R.missing_pages(docs, left), left).select("doc_id")


@query("""
SELECT doc_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 3 AS shard FROM documents) WHERE shard = 1
  AND doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT item_id FROM benchmark)
""")
def sel_documents(spark, d):
    """The second of three tasks, less what labels say is done and what has failed."""
    docs = table(spark, d, "documents").select("doc_id")
    return R.select_documents(docs, table(spark, d, "labels"), table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")), ["doc_id"], 1, 3)
