"""Chat formatting by quotation linking, in built-in functions only.

Messages quote earlier ones with ``>`` marks, nested once per level. A message's lines are parsed into its own text
(level 0) and quoted passages: runs of lines of one level, cut at blank lines. Passages and the paragraphs of own
texts, and the sentences of both, are normalised (lower case, white space runs as one blank) and hashed; a quoted
passage or sentence of any level is joined to the message that said it first: the earliest turn before it in its own
conversation if there is one, else the first turn of another conversation (the one with the least id; if that is its own,
the one with the greatest). ``quote_links`` returns these links, one row per message, level and quoted message.

A message answers the one that its outermost linked level points to: the one that whole passages cover most characters
of, then the one that sentences do; ties go to the earliest message. Without a linked quote it follows the turn
before it that exists.

Conversations joined by answers, in whatever order their ids stand, form a thread: a component of that graph, named by
its smallest id. A conversation continues the one that its first answer out of itself goes to; ``depth`` counts how many
it continues one after another. Conversations that quote each other in a circle start at the smallest id of it. The
result is one row per message, ready to be written in reply order by ``thread_id, depth, conv_id, turn``, with its own
text only, formatted for chat training. Nothing gathers a conversation: a row carries its place instead.

Results: null texts count as empty and stay as messages; repeated rows stay, and are numbered alike; null
conversations or turns link to nothing and are linked by nothing; an attribution line (ends in ``wrote:``) right
before a quote belongs to the quote. Parts of a sentence link to nothing. Any character may occur in a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.llm.components import connected_components
from glossaflow.scratch import scratch_folder, stage

# How a message of a role begins and ends in the formatted text.
CHAT_TEMPLATE = ("<|{role}|>\n", "\n<|end|>")
_MARKS = r"^\s*(?:>\s?)+"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def passage_hash(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(normalised(text), 256), 1, 32))


def parse_lines(messages: DataFrame) -> DataFrame:
    """``messages`` with ``lines``: an array of ``(level, body)`` per line of ``text``, marks removed.

    An attribution line gets the level of the quote it introduces, and no body.
    """
    split = F.split(F.coalesce(F.col("text"), F.lit("")), r"\r?\n")
    line = lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _MARKS, "").alias("body"))
    raw = messages.withColumn("__raw", F.transform(split, line))
    introduces = lambda x, i: (
        x["body"].rlike(r"\bwrote:\s*$") & (F.coalesce(F.get("__raw", i + 1)["level"], F.lit(0)) > x["level"])
    )
    marked = F.transform(
        "__raw",
        lambda x, i: F.struct(
            F.when(introduces(x, i), F.get("__raw", i + 1)["level"]).otherwise(x["level"]).alias("level"),
            F.when(introduces(x, i), "").otherwise(x["body"]).alias("body"),
        ),
    )
    return raw.withColumn("lines", marked).drop("__raw")


def passages(parsed: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, at, passage)``: paragraphs of own text (level 0) and quoted passages, by their first line.

    A passage starts wherever the level changes or a line is blank.
    """
    line = lambda i: F.get("lines", i)
    starts = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0) | (line(i - 1)["level"] != line(i)["level"]) | (F.trim(line(i)["body"]) == ""),
    )
    cut = parsed.withColumn("__starts", starts)
    until = lambda j: F.coalesce(F.get("__starts", j + 1), F.size("lines"))
    pieces = F.transform(
        "__starts",
        lambda at, j: F.struct(
            line(at)["level"].alias("level"), at.alias("at"),
            F.array_join(F.transform(F.slice("lines", at + 1, until(j) - at), lambda x: x["body"]), "\n").alias("passage"),
        ),
    )
    found = cut.select("conv_id", "turn", F.inline(pieces))
    return found.where(normalised(F.col("passage")) != "")


def hashed_parts(found: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, at, whole, size, hash)``: every passage, and its sentences if it has several."""
    text = normalised(F.col("passage"))
    sentences = F.split(text, r"(?<=[.!?\u3002\uff01\uff1f])\s")
    part = lambda x, whole: F.struct(
        F.lit(whole).alias("whole"), F.length(x).alias("size"), passage_hash(x).alias("hash"))
    several = F.when(F.size("sentences") > 1, F.transform("sentences", lambda x: part(x, False)))
    split = found.select("conv_id", "turn", "level", "at", text.alias("text"), sentences.alias("sentences"))
    parts = F.concat(F.array(part(F.col("text"), True)), F.coalesce(several, F.array().cast(
        "array<struct<whole:boolean,size:int,hash:binary>>")))
    return split.select("conv_id", "turn", "level", "at", F.inline(parts))


def own_text() -> Column:
    own = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"])
    joined = F.regexp_replace(F.array_join(own, "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(joined, r"^\s+|\s+$", "")


def quote_links(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, to_conv, to_turn, whole, covered, n_linked)``: one row for each message that a message
    quotes at a level; characters linked as whole passages, and in all, and the number of passages.

    Tables that copies are joined to are written first, so a passage that many quote is split over tasks.
    """
    folder = scratch_folder(messages.sparkSession)
    found = passages(parse_lines(messages)).where("conv_id is not null and turn is not null")
    hashed = stage(hashed_parts(found), "parts", folder)
    quotes = hashed.where("level > 0")
    wanted = stage(quotes.select("hash").distinct(), "wanted", folder)
    # Who said it first: one row per part and conversation, and per part; combined before the shuffle.
    said = hashed.where("level = 0").select("hash", "conv_id", "turn").join(wanted, "hash", "left_semi")
    here = stage(said.groupBy("hash", "conv_id").agg(F.min("turn").alias("here")), "here", folder)
    place = F.struct(F.col("conv_id").alias("c"), F.col("here").alias("t"))
    anywhere = stage(
        here.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")), "anywhere", folder)
    joined = quotes.join(here, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    target = (
        F.when(F.col("here") < F.col("turn"), place)
        .when(F.col("first.c") != F.col("conv_id"), F.col("first"))
        .when(F.col("last.c") != F.col("conv_id"), F.col("last"))
    )
    linked = joined.withColumn("to", target).where("to is not null")
    # A passage counts once per message it leads to, by its whole or by those of its sentences that do.
    by_passage = linked.groupBy("conv_id", "turn", "level", "at", "to").agg(
        F.max(F.when(F.col("whole"), F.col("size"))).alias("whole"),
        F.sum(F.when(~F.col("whole"), F.col("size"))).alias("sentences"),
    )
    return by_passage.groupBy("conv_id", "turn", "level", "to").agg(
        F.coalesce(F.sum("whole"), F.lit(0)).alias("whole"),
        F.sum(F.coalesce("whole", "sentences")).alias("covered"), F.count("*").alias("n_linked"),
    ).select("conv_id", "turn", "level", F.col("to.c").alias("to_conv"), F.col("to.t").alias("to_turn"), "whole", "covered",
             "n_linked")


def reply_links(links: DataFrame) -> DataFrame:
    """``(conv_id, turn, to_conv, to_turn, n_linked)``: of ``quote_links``, the message that each message answers."""
    order = F.struct((-F.col("level")).alias("l"), "whole", "covered", (-F.col("to_conv")).alias("c"),
                     (-F.col("to_turn")).alias("t"), "n_linked")
    best = links.groupBy("conv_id", "turn").agg(F.max(order).alias("best"))
    return best.select("conv_id", "turn", (-F.col("best.c")).alias("to_conv"), (-F.col("best.t")).alias("to_turn"),
                       F.col("best.n_linked").alias("n_linked"))


def _followed(parents: DataFrame, folder: str, name: str) -> DataFrame:
    """``(conv_id, at, depth, least)``: where ``parents`` (``conv_id, at``) lead, by jumps that double each time.

    Stops when all have ended, or when jumps are longer than there are rows: what still goes on then goes round a circle.
    """
    jumps = stage(parents.select("conv_id", "at", F.lit(1).cast("long").alias("depth"), F.col("at").alias("least")),
                  f"{name}0", folder)
    rows, turn = jumps.count(), 0
    while 1 << turn <= rows:
        further = jumps.select(F.col("conv_id").alias("at"), F.col("at").alias("on"), F.col("depth").alias("more"),
                               F.col("least").alias("other"))
        moved = jumps.join(further, "at", "left")
        if moved.where("on is not null").isEmpty():
            break
        turn += 1
        jumps = stage(moved.select(
            "conv_id", F.coalesce("on", "at").alias("at"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.least("least", "other").alias("least"),
        ), f"{name}{turn}", folder)
    return jumps


def threads(links: DataFrame) -> DataFrame:
    """``(conv_id, thread_id, depth)`` of the conversations that answers (``reply_links``) join to another one."""
    folder = scratch_folder(links.sparkSession)
    between = links.where("conv_id != to_conv")
    if between.isEmpty():
        return between.select("conv_id", F.col("to_conv").alias("thread_id"), F.lit(0).cast("long").alias("depth"))
    named = connected_components(between.select(F.col("conv_id").alias("a"), F.col("to_conv").alias("b")).distinct())
    parents = stage(
        between.groupBy("conv_id").agg(F.min(F.struct("turn", "to_conv")).alias("first"))
        .select("conv_id", F.col("first.to_conv").alias("at")), "parents", folder,
    )
    depths = _followed(parents, folder, "jumps")
    endless = stage(
        depths.join(parents.select(F.col("conv_id").alias("at")), "at", "left_semi").select("at", "conv_id", "least"),
        "endless", folder,
    )
    if not endless.isEmpty():
        # Where endless ways lead after that many steps is on the circle; its smallest id has no parent any more.
        circle = endless.select(F.col("at").alias("conv_id")).distinct()
        starts = endless.join(circle, "conv_id", "left_semi").select(F.col("least").alias("conv_id")).distinct()
        depths = _followed(parents.join(starts, "conv_id", "left_anti"), folder, "opened")
    return named.select(F.col("node").alias("conv_id"), F.col("component").alias("thread_id")).join(
        depths.select("conv_id", "depth"), "conv_id", "left"
    ).select("conv_id", "thread_id", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


def turns_before(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, before)``: every turn of a conversation with the turn before it, if there is one.

    Turns are cut into chunks of even size by order; a chunk's first turn takes its neighbour from the chunk before, so a
    long conversation is no group of a window.
    """
    folder = scratch_folder(messages.sparkSession)
    turns = messages.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    chunks = stage(
        turns.repartitionByRange("conv_id", "turn").withColumn("chunk", F.spark_partition_id()), "turns", folder)
    at = F.struct("conv_id", "turn")
    ends = chunks.groupBy("chunk").agg(F.max(at).alias("end"))  # one row per chunk
    ends = ends.select("chunk", F.lag("end").over(Window.orderBy("chunk")).alias("end"))
    in_chunk = F.lag(at).over(Window.partitionBy("chunk").orderBy("conv_id", "turn"))
    placed = chunks.withColumn("__at", in_chunk).join(F.broadcast(ends), "chunk")
    before = F.coalesce("__at", "end")
    return placed.select("conv_id", "turn", F.when(before["conv_id"] == F.col("conv_id"), before["turn"]).alias("before"))


def chat_messages(messages: DataFrame) -> DataFrame:
    """One row per message: ``(thread_id, depth, conv_id, turn, role, reply_to_conv, reply_to_turn, linked_quotes,
    quote_level, content, chat)``."""
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), "text",
    )
    folder = scratch_folder(messages.sparkSession)
    links = stage(reply_links(quote_links(rows)), "links", folder)
    places = stage(turns_before(rows).join(links, ["conv_id", "turn"], "left"), "places", folder)
    placed = stage(threads(links), "threads", folder)
    parsed = parse_lines(rows)
    begin, end = CHAT_TEMPLATE
    before, after = begin.split("{role}")
    highest = F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0))
    own = parsed.select("conv_id", "turn", "role", highest.alias("quote_level"), own_text().alias("content"))
    linked = own.join(places, ["conv_id", "turn"], "left").join(placed, "conv_id", "left")
    follows = F.col("to_conv").isNull() & F.col("before").isNotNull()
    return linked.select(
        F.coalesce("thread_id", "conv_id").alias("thread_id"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "conv_id", "turn", "role",
        F.when(follows, F.col("conv_id")).otherwise(F.col("to_conv")).alias("reply_to_conv"),
        F.when(follows, F.col("before")).otherwise(F.col("to_turn")).alias("reply_to_turn"),
        F.coalesce("n_linked", F.lit(0)).alias("linked_quotes"), "quote_level", "content",
        F.concat(F.lit(before), F.coalesce("role", F.lit("user")), F.lit(after), "content", F.lit(end)).alias("chat"),
    )
