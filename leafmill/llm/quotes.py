"""Operator 8: conversations by quotation linking, in DataFrame functions alone.

A line that begins with `>` marks is quoted at the level of their number; the rest
is the message's own. Runs of lines of one level without a blank line between are
passages. Passages, and the lines of those that have several, are compared by the
hash of their text without marks, case and extra white space. A quoted passage belongs
to the first message that has it as its own passage or line: of the same conversation
and an earlier turn, else of any earlier conversation (by id). Where the whole passage
is nobody's, as in a trimmed or interleaved quote, its lines are looked for one by one.
A message answers the original of its first linked passage of least level, and without
one the message before it in its conversation. Threads are what the answers connect;
depth orders a thread so that a reply follows what it answers.

Work on a conversation goes by ranges of all messages in order and a table of the
ranges, so a conversation that holds much of the data is split, whatever its turns. Originals are reduced to the
first message of each passage before they meet the quotes.

A null text is empty; a null turn counts as -1; null conv_ids form one conversation
before all others. Rows with equal conv_id and turn are ordered by role and a hash of
the text. An empty table gives no rows; long texts are split into lines like others.
Passages and lines under MIN_CHARS characters are linked within their conversation alone.
Of messages that tie the one of least conversation and turn counts. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm import _common as C

MIN_CHARS = 12
MARKS = r"^[ \t]{0,3}((?:>[ \t]?)+)"


def level(line: str) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[^>]", ""))


def normalised(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"\s+", F.lit(" "))))


def passages(messages: DataFrame) -> DataFrame:
    """(mid, level, first, kind, pos, far, h1, h2) of messages (mid, text): whole passages (kind
    0) and the lines of those that have several (kind 1); first: where the passage begins; far:
    long enough to be looked for in other conversations."""
    lines = messages.select("mid", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("level", level("line"))
    lines = lines.withColumn("body", F.regexp_replace("line", MARKS, "")).withColumn("blank", F.trim("body") == "")
    order = Window.partitionBy("mid").orderBy("pos")
    start = F.coalesce(F.col("blank") | F.lag("blank").over(order) | (F.lag("level").over(order) != F.col("level")), F.lit(True))
    runs = lines.withColumn("run", F.sum(start.cast("int")).over(order)).where(~F.col("blank"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "body")))
    whole = runs.groupBy("mid", "run").agg(F.min("level").alias("level"), F.min("pos").alias("first"), parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda x: x["body"]), " ")
    line = F.transform("parts", lambda x: F.struct(F.lit(1).alias("kind"), x["pos"].alias("pos"), x["body"].alias("t")))
    every = F.concat(F.array(F.struct(F.lit(0).alias("kind"), F.col("first").alias("pos"), text.alias("t"))), F.when(F.size("parts") > 1, line).otherwise(F.slice(line, 1, 0)))
    units = whole.select("mid", "level", "first", F.inline(every)).withColumn("t", normalised(F.col("t")))
    return units.select("mid", "level", "first", "kind", "pos", (F.length("t") >= MIN_CHARS).alias("far"), F.xxhash64("t").alias("h1"), F.xxhash64(F.lit("second"), "t").alias("h2"))


def links(messages: DataFrame) -> DataFrame:
    """(mid, to_c, to_t): the message that each quoting message answers."""
    found = C.cut(passages(messages))
    place = messages.select("mid", "c", "t")
    own = found.where("level = 0").select("mid", "h1", "h2", "far").distinct().join(place, "mid")
    first = own.where("far").groupBy("h1", "h2").agg(F.min(F.struct("c", "t")).alias("any"))
    first_here = own.groupBy("c", "h1", "h2").agg(F.min("t").alias("here"))
    quoted = found.where("level > 0").join(place, "mid")
    met = quoted.join(first_here, ["c", "h1", "h2"], "left").join(first, ["h1", "h2"], "left")
    here = F.when(F.col("here") < F.col("t"), F.struct(F.col("c").alias("c"), F.col("here").alias("t")))
    there = F.when(F.col("any.c") < F.col("c"), F.col("any"))
    met = met.withColumn("to", F.coalesce(here, there)).where(F.col("to").isNotNull())
    best = met.groupBy("mid").agg(F.min(F.struct("level", "first", "kind", "pos", "to")).alias("x"))
    return best.select("mid", F.col("x.to.c").alias("to_c"), F.col("x.to.t").alias("to_t"))


def in_order(messages: DataFrame) -> DataFrame:
    """Adds idx (place in the conversation), prev_t and blk: the range of all messages, put in
    order, that a message is in. A conversation spans as many ranges as it needs, also where
    its turns are all equal or null."""
    ranges = max(int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["c", "t", "role", "_text", "mid"]
    rows = messages.withColumn("_text", F.xxhash64("text")).repartitionByRange(ranges, *order).withColumn("blk", F.spark_partition_id())
    rows = C.cut(rows)
    inside = Window.partitionBy("c", "blk").orderBy(*order[1:])
    rows = rows.withColumns({"local": F.row_number().over(inside) - 1, "before": F.lag("t").over(inside)}).drop("_text")
    blocks = rows.groupBy("c", "blk").agg(F.count("*").alias("n"), F.max("t").alias("last"))
    of_all = Window.partitionBy("c").orderBy("blk")
    blocks = blocks.withColumns({"offset": F.coalesce(F.sum("n").over(of_all.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "carry": F.lag("last").over(of_all)})
    rows = rows.join(blocks.select("c", "blk", "offset", "carry"), ["c", "blk"])
    return rows.withColumn("idx", F.col("offset") + F.col("local")).withColumn("prev_t", F.coalesce("before", "carry")).drop("local", "before", "offset", "carry")


def sections(rows: DataFrame) -> DataFrame:
    """Adds start: idx of the message at which its section, an unbroken chain of answers
    to the message before, begins."""
    branch = F.when((F.col("idx") == 0) | F.col("branch"), F.col("idx"))
    inside = Window.partitionBy("c", "blk").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_at", F.max(branch).over(inside))
    blocks = rows.groupBy("c", "blk").agg(F.max("_at").alias("top"))
    before = Window.partitionBy("c").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("carry", F.max("top").over(before)).drop("top")
    return rows.join(blocks, ["c", "blk"]).withColumn("start", F.coalesce("_at", "carry")).drop("_at", "carry", "blk")


def build(conversations: DataFrame) -> DataFrame:
    """One row a message: conv_id, turn, role, text (own lines), n_quoted (lines),
    max_level, linked, parent_conv_id, parent_turn, thread_conv_id, thread_turn, depth."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    base = base.withColumns({"c": F.coalesce("conv_id", F.lit(-(1 << 63))), "t": F.coalesce("turn", F.lit(-1)), "mid": F.monotonically_increasing_id()})
    base = C.cut(base)
    rows = in_order(base).join(links(base), "mid", "left")
    rows = rows.withColumn("branch", F.col("to_t").isNotNull() & ~(F.col("to_c").eqNullSafe(F.col("c")) & F.col("to_t").eqNullSafe(F.col("prev_t"))))
    rows = C.cut(sections(rows))
    # Sections that a quotation hangs elsewhere: (c, start) -> the section and place it answers.
    heads = rows.where("branch").select("c", "start", "to_c", "to_t")
    seats = rows.groupBy("c", "t").agg(F.min(F.struct("idx", "start")).alias("s")).select(F.col("c").alias("to_c"), F.col("t").alias("to_t"), F.col("s.idx").alias("p_idx"), F.col("s.start").alias("p_start"))
    hung = heads.join(seats, ["to_c", "to_t"]).select("c", "start", F.col("to_c").alias("up_c"), F.col("p_start").alias("up"), (F.col("p_idx") - F.col("p_start") + 1).alias("steps"))
    hung = C.cut(hung)
    open_ = not hung.isEmpty()
    while open_:  # pointers double: rounds are the logarithm of how deep sections nest
        over = hung.select(F.col("c").alias("up_c"), F.col("start").alias("up"), F.col("up_c").alias("_c"), F.col("up").alias("_up"), F.col("steps").alias("_steps"))
        far = hung.join(over, ["up_c", "up"], "left")
        open_ = not far.where(F.col("_up").isNotNull()).isEmpty()
        if open_:
            hung = C.cut(far.select("c", "start", F.coalesce("_c", "up_c").alias("up_c"), F.coalesce("_up", "up").alias("up"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")))
    roots = rows.where("idx = start").groupBy("c", "start").agg(F.min("t").alias("root_t")).select(F.col("c").alias("r_c"), F.col("start").alias("r_start"), "root_t")
    out = rows.join(hung, ["c", "start"], "left").withColumns({"r_c": F.coalesce("up_c", "c"), "r_start": F.coalesce("up", "start")}).join(roots, ["r_c", "r_start"])
    ident = lambda c: F.when(c != -(1 << 63), c)
    linked = F.col("to_t").isNotNull()
    parent_t = F.coalesce("to_t", "prev_t")
    lines = F.split("text", "\n")
    quoted = lambda x: x.rlike(MARKS)
    return out.select(
        "conv_id", "turn", "role",
        F.array_join(F.filter(lines, lambda x: ~quoted(x)), "\n").alias("text"),
        F.size(F.filter(lines, quoted)).cast("long").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform(lines, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), r"[^>]", "")))), F.lit(0)).cast("long").alias("max_level"),
        linked.alias("linked"),
        F.when(parent_t.isNotNull(), ident(F.coalesce("to_c", "c"))).alias("parent_conv_id"),
        parent_t.alias("parent_turn"),
        ident(F.col("r_c")).alias("thread_conv_id"),
        F.col("root_t").alias("thread_turn"),
        (F.col("idx") - F.col("start") + F.coalesce("steps", F.lit(0))).cast("long").alias("depth"),
    )


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, linked and without quotes."""
    return build(C.load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


OP8_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, coalesce(turn, -1) AS t FROM conversations
), marks AS (
  SELECT conv_id, t, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT conv_id, t, string_split(text, chr(10)) AS l FROM m)
), lines AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]{0,3}((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t]{0,3}((?:>[ \t]?)+)', '') AS body FROM marks
), starts AS (
  SELECT *, trim(body) = '' AS blank,
         trim(body) = '' OR coalesce(lag(trim(body) = '') OVER w, true) OR coalesce(lag(level) OVER w <> level, true) AS new
  FROM lines WINDOW w AS (PARTITION BY conv_id, t ORDER BY pos)
), runs AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY conv_id, t ORDER BY pos) AS run FROM starts),
passages AS (
  SELECT conv_id, t, run, min(level) AS level, min(pos) AS first, count(*) AS n, string_agg(body, ' ' ORDER BY pos) AS p FROM runs WHERE NOT blank GROUP BY conv_id, t, run
), units AS (
  SELECT conv_id, t, level, first, kind, pos, lower(trim(regexp_replace(p, '\s+', ' ', 'g'))) AS p FROM (
    SELECT conv_id, t, level, first, 0 AS kind, first AS pos, p FROM passages
    UNION ALL
    SELECT r.conv_id, r.t, p.level, p.first, 1, r.pos, r.body FROM runs r JOIN passages p ON p.conv_id = r.conv_id AND p.t = r.t AND p.run = r.run WHERE NOT r.blank AND p.n > 1)
), own AS (SELECT DISTINCT conv_id, t, p FROM units WHERE level = 0),
met AS (
  SELECT q.conv_id, q.t, q.level, q.first, q.kind, q.pos, o.conv_id AS to_c, o.t AS to_t,
    row_number() OVER (PARTITION BY q.conv_id, q.t, q.first, q.kind, q.pos ORDER BY o.conv_id <> q.conv_id, o.conv_id, o.t) AS k
  FROM units q JOIN own o ON o.p = q.p AND ((o.conv_id = q.conv_id AND o.t < q.t) OR (o.conv_id < q.conv_id AND length(q.p) >= 12))
  WHERE q.level > 0
), links AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, t ORDER BY level, first, kind, pos) AS r FROM met WHERE k = 1) WHERE r = 1
), parents AS (
  SELECT m.conv_id, m.t, links.to_t IS NOT NULL AS linked,
    CASE WHEN links.to_t IS NOT NULL THEN links.to_c WHEN lag(m.t) OVER w IS NOT NULL THEN m.conv_id END AS up_c,
    coalesce(links.to_t, lag(m.t) OVER w) AS up_t
  FROM m LEFT JOIN links ON links.conv_id = m.conv_id AND links.t = m.t WINDOW w AS (PARTITION BY m.conv_id ORDER BY m.t)
), threads AS (
  SELECT conv_id, t, conv_id AS thread_c, t AS thread_t, 0 AS depth FROM parents WHERE up_t IS NULL
  UNION ALL
  SELECT p.conv_id, p.t, h.thread_c, h.thread_t, h.depth + 1 FROM threads h JOIN parents p ON p.up_c = h.conv_id AND p.up_t = h.t
), counts AS (
  SELECT conv_id, t, count(*) FILTER (level > 0) AS n_quoted, max(level) AS max_level,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), '') AS kept FROM lines GROUP BY conv_id, t
)
SELECT m.conv_id, m.turn, m.role, kept AS text, n_quoted, CAST(max_level AS BIGINT) AS max_level, linked,
       up_c AS parent_conv_id, up_t AS parent_turn, thread_c AS thread_conv_id, thread_t AS thread_turn, CAST(depth AS BIGINT) AS depth
FROM m JOIN parents USING (conv_id, t) JOIN threads USING (conv_id, t) JOIN counts USING (conv_id, t)
"""
