r"""Conversations in reply order and without quotes, by linking quoted passages to their originals.

Method: lines that start with ``>`` marks are quotes, as many levels deep as they have marks; a run of lines of one
level is a block, every other line is the message's own. The passages of a text are all of it, its paragraphs, lines
and sentences, each as its words in folded case. Passages of blocks meet the passages of all messages' own
text by 128-bit hashes, in equi-joins, and what meets is compared word for word on the texts.

1. A passage's original is the latest message before it in its own conversation that has it, else the least (id,
   turn) of another conversation that has it. So a passage has two candidates at most, however many messages share it.
2. A block's original is that of its longest passage that has one; originals in its own conversation come first.
   So excerpts, new line breaks and left out parts are found if one line or sentence is whole; a block
   with less than that of any message is an orphan.
3. A message replies to the original, in its own conversation, of its quotes of the least level, and of those to the
   latest; without such quotes to the message before it. Replies follow what they reply to, depth first, in order of turn.

Quoted lines leave the text. Blocks without an original are listed as orphans, so their text is not lost. Originals in
another conversation are named but move no message: conv_id says where a message belongs.

Defined results: every row is a message of the result once. A null text stays null. Repeated rows stay, and have
the same links. A null turn comes last and is no original, a null conv_id is a conversation of one message
and no original. Rows of one turn go by role and text, nulls last, and replies follow the last of them. Blocks without
words are orphans. Nothing caps levels, lengths, quotes or partners; a conversation is a row of the result, so it is
held whole in one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, map_texts
from tripforge.staging import broadcast_if_small, stage

_MARKS = re.compile(r"[ \t]*(?:>[ \t]*)+")
_PARAGRAPHS = re.compile(r"\n[ \t\r]*\n")
_SENTENCES = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")
_WORDS = re.compile(r"\w+")
#: Texts that may have a quote, in the dialect of Spark.
_MAY_QUOTE = r"(?m)^[ \t]*>"


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and (level, text) of its quoted blocks in order."""
    if ">" not in text:
        return text, []
    own, blocks, before = [], [], 0
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks.group().count(">") if marks else 0
        if not level:
            own.append(line)
        elif level == before:
            blocks[-1][1].append(line[marks.end() :])
        else:
            blocks.append((level, [line[marks.end() :]]))
        before = level
    if not blocks:
        return text, []
    return "\n".join(own).strip("\r\n"), [(level, "\n".join(lines)) for level, lines in blocks]


def passages(text: str) -> list[str]:
    """Distinct normalised passages of a text, longest first, those of one length in order."""
    parts = [text]
    for paragraph in _PARAGRAPHS.split(text):
        parts += [paragraph, *paragraph.split("\n"), *_SENTENCES.split(paragraph)]
    normal = dict.fromkeys(" ".join(_WORDS.findall(p.casefold())) for p in parts)
    normal.pop("", None)
    return sorted(normal, key=len, reverse=True)


def _key(passage: str) -> bytes:
    return hashlib.blake2b(passage.encode(), digest_size=16).digest()


_PASSAGE = T.StructType().add("key", "binary").add("passage", "string")
_BLOCK = T.StructType().add("level", "integer").add("passages", T.ArrayType(_PASSAGE))


def _quoted(texts: pa.Array) -> list[pa.Array]:
    made = [
        [
            {"level": level, "passages": [{"key": _key(p), "passage": p} for p in passages(block)]}
            for level, block in parse(text or "")[1]
        ]
        for text in texts.to_pylist()
    ]
    inner = pa.struct([("key", pa.binary()), ("passage", pa.string())])
    return [pa.array(made, pa.list_(pa.struct([("level", pa.int32()), ("passages", pa.list_(inner))])))]


def _own_keys(texts: pa.Array) -> list[pa.Array]:
    made = [[_key(p) for p in passages(parse(text or "")[0])] for text in texts.to_pylist()]
    return [pa.array(made, pa.list_(pa.binary()))]


def _in_own_conversation(quoted: DataFrame, held: DataFrame) -> DataFrame:
    """Quoted passages with the latest earlier turn of their conversation that has them."""
    # At one turn quotes sort before passages, so a message is no original of its own turn.
    columns = quoted.columns
    empty = [F.lit(None).cast(quoted.schema[c].dataType).alias(c) for c in columns if c not in held.columns]
    both = quoted.where("conv IS NOT NULL").select(*columns, F.lit(0).alias("kind")).unionByName(
        held.select(*held.columns, *empty, F.lit(1).alias("kind"))
    )
    before = (
        Window.partitionBy("conv", "key")
        .orderBy(F.col("turn").asc_nulls_last(), "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    turn = F.last(F.when(F.col("kind") == 1, F.col("turn")), ignorenulls=True).over(before)
    found = both.withColumn("to_turn", turn).where("kind = 0 AND to_turn IS NOT NULL")
    return found.select(*columns, F.col("conv").alias("to_conv"), "to_turn")


def _in_others(quoted: DataFrame, held: DataFrame) -> DataFrame:
    """Quoted passages with the least message of another conversation that has them."""
    place = F.min(F.struct("conv", "turn"))
    first = held.groupBy("key").agg(place.alias("first"))
    second = held.join(first, "key").where("conv <> first.conv").groupBy("key").agg(place.alias("second"))
    least = stage(first.join(second, "key", "left"), "least-originals")
    to = F.when(F.col("first.conv").eqNullSafe(F.col("conv")), F.col("second")).otherwise(F.col("first"))
    found = quoted.join(least, "key").withColumn("to", to).where("to IS NOT NULL")
    return found.select(*quoted.columns, F.col("to.conv").alias("to_conv"), F.col("to.turn").alias("to_turn"))


def _verified(candidates: DataFrame, messages: DataFrame) -> DataFrame:
    """The candidates whose original has the passage in its own text.

    What is asked of an original is gathered first, so its text is parsed once; passages that met one of its own are at
    most as many as it has.
    """
    pairs = candidates.select("to_conv", "to_turn", "key", "passage").distinct()
    asked = pairs.groupBy("to_conv", "to_turn").agg(F.collect_list(F.struct("key", "passage")).alias("asked"))
    texts = messages.select(F.col("conv").alias("to_conv"), F.col("turn").alias("to_turn"), "text")
    compared = bound_batches(asked.join(texts, ["to_conv", "to_turn"])).select("to_conv", "to_turn", "asked", "text")
    names = pairs.columns

    def run(batches):
        for batch in batches:
            place, keys, found = [], [], []
            for row, (asked_of, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("asked", "text")))):
                own = set(passages(parse(text or "")[0]))
                for one in asked_of:
                    if one["passage"] in own:
                        place.append(row)
                        keys.append(one["key"])
                        found.append(one["passage"])
            of = batch.select(["to_conv", "to_turn"]).take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=names)

    true = stage(compared.mapInArrow(run, pairs.schema).distinct(), "verified-originals")
    return candidates.join(true, names, "left_semi")


def links(messages: DataFrame) -> DataFrame | None:
    """(conv, turn, digest, block, to_conv, to_turn) of every block with an original; written.

    ``messages``: (conv, turn, role, text). None if no message quotes. ``digest`` is that of the text.
    """
    source = messages.where(F.col("text").rlike(_MAY_QUOTE))
    source = source.select("conv", "turn", F.unhex(F.md5("text")).alias("digest"), "text")
    blocks = map_texts(source, ["conv", "turn", "digest"], "text", [T.StructField("blocks", T.ArrayType(_BLOCK))], _quoted)
    blocks = blocks.dropDuplicates(["conv", "turn", "digest"])
    each = blocks.select("conv", "turn", "digest", F.posexplode("blocks").alias("block", "one"))
    each = each.select("conv", "turn", "digest", "block", F.posexplode("one.passages").alias("place", "p"))
    quoted = stage(each.select("conv", "turn", "digest", "block", "place", "p.key", "p.passage"), "quoted-passages")
    if quoted.isEmpty():
        return None
    # Only passages that are quoted somewhere leave the task that reads them.
    wanted = broadcast_if_small(stage(quoted.select("key").distinct(), "quoted-keys"))
    own = messages.where("conv IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL")
    keys = T.StructField("keys", T.ArrayType(T.BinaryType()))
    held = map_texts(own, ["conv", "turn"], "text", [keys], _own_keys)
    held = held.select("conv", "turn", F.explode("keys").alias("key")).join(wanted, "key", "left_semi")
    held = stage(held.select("conv", "turn", "key").distinct(), "own-passages")
    candidates = stage(_in_own_conversation(quoted, held).union(_in_others(quoted, held)), "originals")
    best = F.min(F.struct(~F.col("to_conv").eqNullSafe(F.col("conv")), "place", "to_conv", "to_turn")).alias("best")
    chosen = _verified(candidates, own).groupBy("conv", "turn", "digest", "block").agg(best)
    return stage(
        chosen.select("conv", "turn", "digest", "block", "best.to_conv", "best.to_turn"),
        "quotation-links",
    )


def reply_order(parents: list[int | None]) -> list[int]:
    """Places depth first, in order under each parent; a parent stands before its replies."""
    under: dict[int | None, list[int]] = {}
    for place, parent in enumerate(parents):
        under.setdefault(parent, []).append(place)
    order, waiting = [], under.get(None, [])[::-1]
    while waiting:
        place = waiting.pop()
        order.append(place)
        waiting += under.get(place, [])[::-1]
    return order


def _order(message: dict) -> tuple:
    """Sorts by turn, role and text, nulls last."""
    turn = message["turn"]
    return (turn is None, 0 if turn is None else turn, *[(v is None, v or "") for v in (message["role"], message["text"])])


def form(conv, messages: list[dict], found: list[dict]) -> list[dict]:
    """One conversation's messages in reply order, without quotes."""
    to = {(x["turn"], x["digest"], x["block"]): (x["to_conv"], x["to_turn"]) for x in found}
    messages = sorted(messages, key=_order)
    last_of = {m["turn"]: place for place, m in enumerate(messages)}
    parents, made = [], []
    for place, message in enumerate(messages):
        text, quotes, orphans, near = message["text"], [], [], []
        if text is not None:
            digest = hashlib.md5(text.encode()).digest()
            text, blocks = parse(text)
            for block, (level, passage) in enumerate(blocks):
                original = to.get((message["turn"], digest, block))
                if original is None:
                    orphans.append({"level": level, "text": passage})
                    continue
                quotes.append({"level": level, "conv_id": original[0], "turn": original[1]})
                if conv is not None and original[0] == conv:
                    near.append((-level, original[1]))
        parent = last_of[max(near)[1]] if near else place - 1 if place else None
        parents.append(parent)
        reply_to = None if parent is None else messages[parent]["turn"]
        made.append(
            {"turn": message["turn"], "role": message["role"], "text": text, "reply_to": reply_to,
             "quotes": quotes, "orphans": orphans}
        )
    return [made[place] for place in reply_order(parents)]


def conversations(df: DataFrame) -> DataFrame:
    """(conv_id, messages) of every conversation: messages in reply order, without quotes.

    ``df``: conv_id, turn, role, text. A message: turn, role, text, reply_to (a turn of the conversation), quotes
    (level and the original's conv_id and turn) and orphans (level and text of blocks without an original).
    """
    messages = df.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    found = links(messages)
    conv, turn = (messages.schema[c].dataType for c in ("conv", "turn"))
    one = F.struct("turn", "role", "text")
    whole = messages.where("conv IS NOT NULL").groupBy("conv").agg(F.collect_list(one).alias("messages"))
    lone = messages.where("conv IS NULL").select("conv", F.array(one).alias("messages"))
    link = F.struct("turn", "digest", "block", "to_conv", "to_turn")
    if found is None:
        shape = T.ArrayType(
            T.StructType().add("turn", turn).add("digest", "binary").add("block", "integer").add("to_conv", conv).add("to_turn", turn)
        )
        formed = whole.union(lone).withColumn("links", F.lit(None).cast(shape))
    else:
        of_whole = found.where("conv IS NOT NULL").groupBy("conv").agg(F.collect_list(link).alias("links"))
        of_lone = found.where("conv IS NULL").groupBy("turn", "digest").agg(F.collect_list(link).alias("links"))
        digest = F.unhex(F.md5(F.col("messages")[0]["text"]))
        met = (digest == of_lone["digest"]) & F.col("messages")[0]["turn"].eqNullSafe(of_lone["turn"])
        formed = whole.join(of_whole, "conv", "left").union(
            lone.join(of_lone, met, "left").select("conv", "messages", "links")
        )
    quote = T.StructType().add("level", "integer").add("conv_id", conv).add("turn", turn)
    orphan = T.StructType().add("level", "integer").add("text", "string")
    message = (
        T.StructType()
        .add("turn", turn)
        .add("role", "string")
        .add("text", "string")
        .add("reply_to", turn)
        .add("quotes", T.ArrayType(quote))
        .add("orphans", T.ArrayType(orphan))
    )
    schema = T.StructType().add("conv_id", conv).add("messages", T.ArrayType(message))

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv", "messages", "links")))
            made = [{"conv_id": c, "messages": form(c, m, x or [])} for c, m, x in rows]
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return bound_batches(formed).select("conv", "messages", "links").mapInArrow(run, schema)
