"""Chat formatting by quotation linking.

A message's lines carry quote levels (``>`` marks, nested). Lines of one level that
follow each other are a passage. Passages that quote are hashed without marks,
spacing and case, and joined to the message where the same passage first stood
unquoted; that message is answered. Messages in reply order, without what they
quote, make the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provender.llm.walks import bound, over_runs, run_ends
from provender.session import written

ADDED = ("body", "quotes", "linked", "reply_to", "thread", "position", "formatted")
#: One mark of a quote level, with the spaces that mail programs put around it.
MARK = r"^[ \t]*(?:>[ \t]?)+"
#: Messages of a chunk in which places are counted.
CHUNK = 1024
#: Tasks that may share the passages of one conversation.
SALTS = 8


def passages(text: Column) -> Column:
    """The text as an array of (level, text): runs of lines of one level; blank lines end a run."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda line: F.struct(
        F.regexp_count(F.regexp_extract(line, MARK, 0), F.lit(">")).alias("level"),
        F.regexp_replace(line, F.lit(MARK), F.lit("")).alias("text")))

    def cut(told: Column) -> Column:
        kinds = F.transform(told, lambda line: F.struct(line["level"].alias("level"), (F.trim(line["text"]) == "").alias("blank")))
        return over_runs(run_ends(kinds), lambda first, size: F.struct(
            F.get(told, first)["level"].alias("level"),
            F.array_join(F.transform(F.slice(told, first + 1, size), lambda line: line["text"]), "\n").alias("text")))

    return bound(lines, cut)


def passage_key(text: Column) -> Column:
    """What quoted and original wording share: a hash without spacing and case; null for blank text."""
    plain = F.lower(F.trim(F.regexp_replace(text, F.lit(r"\s+"), F.lit(" "))))
    return F.when(plain != "", F.sha2(plain.cast("binary"), 256))


def link_quotes(messages: DataFrame) -> DataFrame:
    """Every message with its ``body`` and what it answers, in reply order.

    ``messages`` has ``conv_id, turn, role, text``. Adds

    * ``body``: the text without quoted lines and the blank lines around it,
    * ``quotes``: passages that it quotes, ``linked``: those found in an earlier
      message of the conversation,
    * ``reply_to``: the latest message from which a passage of the lowest linked
      level came; null where nothing is linked,
    * ``thread``: the message at the root of the replies (its own turn without one),
    * ``position``: the place from 1 in the conversation when threads follow each
      other by their root and a thread goes by turn, so an answer follows what it
      answers,
    * ``formatted``: the role and the body as a chat turn.

    A passage belongs to the first message of the conversation where it stands
    unquoted, if that is earlier than the quoting message. Input columns of the
    added names are replaced, others kept. A null text is an empty one; a message
    with a null conversation or turn links with nothing and has position null.
    Messages that repeat a turn are rows of their own, and an answer to the turn
    answers them all. An empty table gives no rows.
    """
    kept = {f"_kept{i}": c for i, c in enumerate(messages.columns) if c not in ADDED}
    rows = written(messages.select(
        *[F.col(f"`{c}`").alias(name) for name, c in kept.items()], F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("at"),
        F.col("role").alias("who"), passages(F.col("text")).alias("runs"), F.monotonically_increasing_id().alias("row")),
        "messages")
    parts = rows.where("conv IS NOT NULL AND at IS NOT NULL").select("row", "conv", "at", F.explode("runs").alias("p")).select(
        "row", "conv", "at", F.col("p.level").alias("level"), passage_key(F.col("p.text")).alias("key")
    ).where(F.col("key").isNotNull())
    # One row per passage of a conversation, however often it stands there.
    first = parts.where("level = 0").groupBy("conv", "key").agg(F.min("at").alias("origin"))
    quoted = parts.where("level > 0").withColumn("salt", F.pmod("row", F.lit(SALTS)))
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    found = quoted.join(salted, ["conv", "key", "salt"], "left").withColumn(
        "origin", F.when(F.col("origin") < F.col("at"), F.col("origin")))
    answered = found.groupBy("row").agg(
        F.count("*").alias("quotes"), F.count("origin").alias("linked"),
        F.max(F.when(F.col("origin").isNotNull(), F.struct(-F.col("level"), "origin"))).getField("origin").alias("reply_to"))
    linked = written(rows.select("row", "conv", "at").join(answered, "row", "left"), "linked")
    threads = _roots(linked.where("conv IS NOT NULL AND at IS NOT NULL").groupBy("conv", "at").agg(
        F.max("reply_to").alias("up")))
    placed = _positions(linked.join(threads, ["conv", "at"], "left"))
    body = F.regexp_replace(F.array_join(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["text"]), "\n"),
                            F.lit(r"^\s+|\s+$"), F.lit(""))
    out = rows.join(placed, "row")
    return out.select(
        *[F.col(name).alias(c) for name, c in kept.items()], body.alias("body"),
        F.coalesce("quotes", F.lit(0)).cast("bigint").alias("quotes"), F.coalesce("linked", F.lit(0)).cast("bigint").alias("linked"),
        "reply_to", "thread", "position",
        F.concat(F.lit("<|"), F.coalesce("who", F.lit("unknown")), F.lit("|>\n"), body, F.lit("\n")).alias("formatted"))


def _roots(links: DataFrame) -> DataFrame:
    """Root of every message's replies: each round doubles the steps a message looks up."""
    now = written(links.select("conv", "at", F.coalesce("up", "at").alias("up")), "replies")
    while True:
        above = now.where("up <> at").select(F.col("conv"), F.col("at").alias("up"), F.col("up").alias("higher"))
        moved = now.join(above, ["conv", "up"], "left").select(
            "conv", "at", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved"))
        now = written(moved, "replies")
        if not now.where("moved").limit(1).count():
            return now.select("conv", "at", F.col("up").alias("thread"))


def _positions(rows: DataFrame) -> DataFrame:
    """Places in a conversation by (thread, turn), counted inside chunks and summed over them.

    A chunk is a stretch of threads and one of turns, so no task needs a whole
    conversation.
    """
    ranked = rows.where("conv IS NOT NULL AND at IS NOT NULL").select(
        "row", "conv", "at", "thread", "quotes", "linked", "reply_to")
    by_thread = ranked.groupBy("conv", "thread").agg(F.count("*").alias("n"))
    stretch = F.floor(F.col("thread") / CHUNK)
    sums = by_thread.groupBy("conv", stretch.alias("stretch")).agg(F.sum("n").alias("n"))
    over = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "stretch", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("stretch_before"))
    inside = Window.partitionBy("conv", "stretch").orderBy("thread").rowsBetween(Window.unboundedPreceding, -1)
    thread_before = by_thread.withColumn("stretch", stretch).withColumn(
        "inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, ["conv", "stretch"]).select(
        "conv", "thread", (F.col("inside") + F.col("stretch_before")).alias("thread_before"))
    # The same within a thread, by stretches of turns.
    piece = F.floor(F.col("at") / CHUNK)
    turns = ranked.groupBy("conv", "thread", piece.alias("piece")).agg(F.count("*").alias("n"))
    along = Window.partitionBy("conv", "thread").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.select("conv", "thread", "piece", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("piece_before"))
    here = Window.partitionBy("conv", "thread", "piece").orderBy("at", "row")
    placed = (
        ranked.withColumn("piece", piece).withColumn("place", F.row_number().over(here))
        .join(turns, ["conv", "thread", "piece"]).join(thread_before, ["conv", "thread"])
        .select("row", "quotes", "linked", "reply_to", "thread",
                (F.col("place") + F.col("piece_before") + F.col("thread_before")).cast("bigint").alias("position"))
    )
    rest = rows.where("conv IS NULL OR at IS NULL").select(
        "row", "quotes", "linked", "reply_to", F.col("at").alias("thread"), F.lit(None).cast("bigint").alias("position"))
    return placed.unionByName(rest)
