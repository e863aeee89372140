"""Quotation linking for mail-like conversations, in DataFrame functions alone.

A line that begins with one or more `>` is quoted, their number is its level. Lines that follow one another on one level
form a passage; a blank quoted line ends it. Passages and their lines are normalised (A-Z lowered, white space collapsed)
and hashed (SHA-256), and so are the own texts of messages and their lines. A passage belongs to the earliest message
of its conversation, before the quoting one, whose whole own text it is, else to the earliest that has one of its
lines. A message replies to the original of its outermost linked passage, of several to the latest; replies form
threads, whose roots and depths are found by following pointers in doubling steps.

The result has one row per message, without its quotes: conv_id, turn, role, text, n_quotes, n_linked, parent_turn,
root_turn, depth. Ordered by conv_id, root_turn, turn, each reply stands in its thread and after its original.

Defined cases: null text is empty; null conv_id or turn links nothing (root_turn is turn); rows with equal conv_id, turn
and text share their links, each keeps its row; of several messages with one conv_id and turn, all may be originals; an
empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
QUOTED = r"^[ \t]*>[ \t>]*"
MESSAGE = ["conv_id", "turn", "key"]


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), r"[ \t\r\n]+", " "))


def own_text(text: Column) -> Column:
    """The text without its quoted lines."""
    return F.btrim(F.regexp_replace(text, r"(?md)^[ \t]*>[^\n]*(?:\n|$)", ""), F.lit(" \t\r\n"))


def passages(messages: DataFrame) -> DataFrame:
    """One row per quoted passage: the message, passage (number in it), level, lines (normalised)."""
    lines = messages.where(F.col("text").rlike(r"(?md)^[ \t]*>")).select(*MESSAGE, "text").distinct().select(
        *MESSAGE, F.posexplode(F.split("text", "\n")).alias("i", "line"))
    prefix = F.regexp_extract("line", QUOTED, 0)
    lines = lines.where(prefix != "").select(
        *MESSAGE, "i", F.length(F.regexp_replace(prefix, "[^>]", "")).alias("level"),
        normal(F.regexp_replace("line", QUOTED, "")).alias("line"))
    order = Window.partitionBy(*MESSAGE).orderBy("i")
    follows = ((F.lag("i").over(order) == F.col("i") - 1) & (F.lag("level").over(order) == F.col("level"))
               & (F.lag("line").over(order) != "") & (F.col("line") != ""))
    begins = lines.withColumn("begins", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = begins.withColumn("passage", F.sum("begins").over(run)).where("line <> ''")
    gathered = numbered.groupBy(*MESSAGE, "passage", "level").agg(  # the lines of one message at most
        F.sort_array(F.collect_list(F.struct("i", "line"))).alias("rows"))
    return gathered.select(*MESSAGE, "passage", "level", F.col("rows.line").alias("lines"))


def link(messages: DataFrame) -> DataFrame:
    """Passages with origin_turn, null where no earlier message of the conversation has their words."""
    quotes = store.stage(passages(messages), "passages")
    wanted = quotes.select("conv_id").distinct()
    own = messages.join(wanted, "conv_id", "left_semi").select("conv_id", "turn", own_text(F.col("text")).alias("own"))
    whole = own.select("conv_id", "turn", F.lit(0).alias("part"), normal(F.col("own")).alias("words"))
    parts = own.select("conv_id", "turn", F.lit(1).alias("part"), F.explode(F.split("own", "\n")).alias("words")).select(
        "conv_id", "turn", "part", normal(F.col("words")).alias("words"))
    originals = whole.unionByName(parts).where("words <> ''").groupBy(
        "conv_id", "part", F.sha2("words", 256).alias("hash")).agg(F.min("turn").alias("origin"))
    keys = F.concat(F.array(F.struct(F.lit(0).alias("part"), F.array_join("lines", " ").alias("words"))),
                    F.transform("lines", lambda x: F.struct(F.lit(1).alias("part"), x.alias("words"))))
    place = [*MESSAGE, "passage", "level"]
    asked = quotes.select(*place, F.explode(keys).alias("k")).select(
        *place, F.col("k.part").alias("part"), F.sha2("k.words", 256).alias("hash"))
    found = asked.join(originals, ["conv_id", "part", "hash"]).where("origin < turn").groupBy(*place).agg(
        F.min(F.struct("part", "origin"))["origin"].alias("origin_turn"))
    return quotes.select(*place).join(found.select(*place, "origin_turn"), place, "left")


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn) -> conv_id, turn, root_turn, depth; pointers double in each round."""
    reach = store.stage(parents.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"),
                                       F.lit(1).alias("depth")), "reach")
    while True:
        ahead = reach.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"),
                             F.col("depth").alias("more"))
        joined = reach.join(ahead, ["conv_id", "root_turn"], "left")
        if joined.where("next IS NOT NULL").isEmpty():
            return reach
        reach = store.stage(joined.select("conv_id", "turn", F.coalesce("next", "root_turn").alias("root_turn"),
                                          (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "reach")


def conversations(messages: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", text.alias("text"),
                           F.sha2(text, 256).alias("key"))
    linked = store.stage(link(rows), "linked")
    replies = linked.groupBy(*MESSAGE).agg(
        F.count("*").alias("n_quotes"), F.count("origin_turn").alias("n_linked"),
        F.min(F.when(F.col("origin_turn").isNotNull(), F.struct("level", (-F.col("origin_turn")).alias("back")))).alias("up"))
    replies = replies.select(*(F.col(c).alias(f"_{c}") for c in MESSAGE), "n_quotes", "n_linked",
                             (-F.col("up.back")).alias("parent_turn"))
    joined = rows.join(replies, [rows[c].eqNullSafe(replies[f"_{c}"]) for c in MESSAGE], "left")
    joined = joined.drop(*(f"_{c}" for c in MESSAGE))
    # Messages that share conv_id and turn are one node of the reply tree: the latest of their parents counts.
    parents = replies.where("parent_turn IS NOT NULL").groupBy(F.col("_conv_id").alias("conv_id"), F.col("_turn").alias("turn")).agg(
        F.max("parent_turn").alias("parent_turn"))
    result = joined.join(threads(parents), ["conv_id", "turn"], "left")
    count = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quotes", "n_linked")]
    return result.select("conv_id", "turn", "role", own_text(F.col("text")).alias("text"), *count, "parent_turn",
                         F.coalesce("root_turn", "turn").alias("root_turn"),
                         F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


def as_mail(messages: DataFrame) -> DataFrame:
    """The messages as mail: two of three quote the message before them, some of these also the one before that."""
    earlier = messages.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    rows = messages.select("conv_id", "turn", "role", "text")
    for back in (1, 2):
        old = earlier.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("text").alias(f"back{back}"))
        rows = rows.join(old, ["conv_id", "turn"], "left")
    quote = [F.when(F.col("turn") % 3 == rest, F.concat(F.lit(mark), F.replace(F.col(text), F.lit("\n"), F.lit(f"\n{mark}"))))
             for rest, mark, text in ((2, ">> ", "back2"),)]
    near = F.when(F.col("turn") % 3 != 0, F.concat(F.lit("> "), F.replace(F.col("back1"), F.lit("\n"), F.lit("\n> "))))
    return rows.select("conv_id", "turn", "role", F.concat_ws("\n", *quote, near, "text").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return conversations(store.table(spark, sf_dir, "conversations"))


def mail_query(spark, sf_dir: str) -> DataFrame:
    """The same over the conversations written as mail, since those of the tables quote nothing."""
    return conversations(as_mail(store.table(spark, sf_dir, "conversations")))


def sql(mail: bool = False) -> str:
    def norm(x: str) -> str:
        return rf"trim(regexp_replace(translate({x}, '{UPPER}', '{LOWER}'), '[ \t\r\n]+', ' ', 'g'))"

    own = r"trim(regexp_replace(text, '(?m)^[ \t]*>[^\n]*(?:\n|$)', '', 'g'), E' \t\r\n')"
    source = """
base AS (SELECT conv_id, turn, role, text FROM conversations),
before AS (SELECT conv_id, turn, min(text) AS text FROM base GROUP BY ALL),
source AS (
  SELECT b.conv_id, b.turn, b.role, concat_ws(chr(10),
           CASE WHEN b.turn % 3 = 2 THEN '>> ' || replace(y.text, chr(10), chr(10) || '>> ') END,
           CASE WHEN b.turn % 3 <> 0 THEN '> ' || replace(x.text, chr(10), chr(10) || '> ') END, b.text) AS text
  FROM base b LEFT JOIN before x ON x.conv_id = b.conv_id AND x.turn = b.turn - 1
              LEFT JOIN before y ON y.conv_id = b.conv_id AND y.turn = b.turn - 2)""" if mail else (
        "\nsource AS (SELECT conv_id, turn, role, text FROM conversations)")
    return rf"""
WITH RECURSIVE {source},
m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM source),
line AS (
  SELECT conv_id, turn, text, i, s[i] AS l
  FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM (SELECT DISTINCT conv_id, turn, text, string_split(text, chr(10)) AS s FROM m))),
q AS (
  SELECT conv_id, turn, text, i, length(regexp_replace(regexp_extract(l, '{QUOTED}'), '[^>]', '', 'g')) AS level,
         {norm(f"regexp_replace(l, '{QUOTED}', '')")} AS l
  FROM line WHERE regexp_matches(l, '{QUOTED}')),
b AS (
  SELECT *, CASE WHEN lag(i) OVER o = i - 1 AND lag(level) OVER o = level AND lag(l) OVER o <> '' AND l <> '' THEN 0 ELSE 1 END AS begins
  FROM q WINDOW o AS (PARTITION BY conv_id, turn, text ORDER BY i)),
n AS (SELECT *, sum(begins) OVER (PARTITION BY conv_id, turn, text ORDER BY i) AS passage FROM b),
p AS (SELECT conv_id, turn, text, passage, level, list(l ORDER BY i) AS ls FROM n WHERE l <> '' GROUP BY ALL),
own AS (SELECT conv_id, turn, {own} AS own FROM m),
orig AS (
  SELECT conv_id, part, w, min(turn) AS origin
  FROM (SELECT conv_id, turn, 0 AS part, {norm('own')} AS w FROM own
        UNION ALL SELECT conv_id, turn, 1, {norm('x')} FROM (SELECT conv_id, turn, unnest(string_split(own, chr(10))) AS x FROM own))
  WHERE w <> '' GROUP BY ALL),
asked AS (
  SELECT conv_id, turn, text, passage, level, 0 AS part, array_to_string(ls, ' ') AS w FROM p
  UNION ALL SELECT conv_id, turn, text, passage, level, 1, unnest(ls) FROM p),
found AS (
  SELECT conv_id, turn, text, passage, level, min_by(origin, part * 1000000000 + origin) AS origin
  FROM asked JOIN orig USING (conv_id, part, w) WHERE origin < turn GROUP BY ALL),
r AS (
  SELECT p.conv_id, p.turn, p.text, count(*) AS n_quotes, count(origin) AS n_linked,
         arg_min(origin, level * 1000000000 - origin) FILTER (origin IS NOT NULL) AS parent
  FROM p LEFT JOIN found USING (conv_id, turn, text, passage, level) GROUP BY ALL),
up AS (SELECT conv_id, turn, max(parent) AS parent FROM r WHERE parent IS NOT NULL GROUP BY ALL),
walk AS (
  SELECT conv_id, turn, parent AS root, 1 AS depth FROM up
  UNION ALL SELECT w.conv_id, w.turn, up.parent, w.depth + 1 FROM walk w JOIN up ON up.conv_id = w.conv_id AND up.turn = w.root),
top AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM walk GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, {own.replace('text', 'm.text')} AS text, CAST(coalesce(n_quotes, 0) AS BIGINT) AS n_quotes,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, CAST(parent AS BIGINT) AS parent_turn,
       CAST(coalesce(top.root, m.turn) AS BIGINT) AS root_turn, CAST(coalesce(top.depth, 0) AS BIGINT) AS depth
FROM m LEFT JOIN r ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.turn IS NOT DISTINCT FROM r.turn AND m.text = r.text
       LEFT JOIN top ON m.conv_id = top.conv_id AND m.turn = top.turn
"""
