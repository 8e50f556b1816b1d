"""Chat formatting by event-sourced reconstruction: a conversation is the fold of its log, and the rendered text is made from the folded messages.

A log has rows ``conv_id, seq, step, event, message, role, text``. Its order is ``seq``, then ``step``. Events:

* ``start`` opens ``message`` with ``role`` at the end of the conversation; its text, if any, is the beginning of the message.
* ``delta`` appends its text to the message.
* ``edit`` replaces the message's text by its own; later deltas append to that.
* ``regenerate`` empties the message, and discards the messages that were started after it and before this event.

The log is dealt out by conversation and message, sorted and folded there; what a regeneration discards is found from the narrow events alone, with minima
per stretch of the log. Messages are rendered and gathered into parts of bounded size, so that a conversation with a third of all rows has many parts, made
by many tasks. A part's loss mask lists the spans that the model learns. Marks of the template and other control strings inside texts and roles get a
backslash after their first character, and one more for each that is there already; that is reversed when the text is read back.

Only :func:`digests` reads a conversation in one task: SHA-256 cannot be put together from hashes of parts. It streams the parts in order and holds one
Arrow batch.

Edge cases: a null text is empty, a null role reads back as an empty one. A null conversation, sequence or message is a value of its own, first in order.
Events of a message that was never started are left out; of several starts the first gives role and place. Unknown events are left out. Repeated rows of
a table of turns are messages of their own (:func:`turn_events`); repeated events of a log are applied twice. Messages with equal places go by message.
An empty log gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import as_table

DELTA = 256
PART = 1 << 15
STRETCH = 1 << 12
FIRST = -(1 << 63)
LOG = ["conv_id", "seq", "step", "event", "message", "role", "text"]
# fixed values: what follows the first character of control strings of public templates
CONTROL = [r"s>", r"/s>", r"INST\]", r"/INST\]", r"SYS>>", r"/SYS>>", r"\|[A-Za-z0-9_]*\|>"]
OPENS = r"([<\[])"


@dataclass(frozen=True)
class Template:
    """A head for each known role, a pair of marks around the name of any other role, a tail for all, and the roles to learn.

    Every mark has to be one of the control strings, so that it cannot occur in an escaped text.
    """

    heads: tuple[tuple[str, str], ...] = (("system", "<|system|>\n"), ("user", "<|user|>\n"), ("assistant", "<|assistant|>\n"))
    other: tuple[str, str] = ("<|other|>", "<|text|>\n")
    tail: str = "</s>\n"
    learnt: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        marks = [h for _, h in self.heads] + [*self.other, self.tail]
        if len(set(marks)) < len(marks):
            raise ValueError("marks must differ")
        for mark in marks:
            if not re.fullmatch(OPENS + f"(?:{'|'.join(CONTROL)})" + r"\n?", mark):
                raise ValueError(f"{mark!r} is no control string")


ZEPHYR = Template()


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, OPENS + rf"(?=\\*(?:{'|'.join(CONTROL)}))", r"$1\\")


_ESCAPED = re.compile(OPENS + rf"\\(?=\\*(?:{'|'.join(CONTROL)}))")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def turn_events(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log of a table ``conv_id, turn, role, text``: each row is a message, started and then streamed in deltas of ``delta`` code points."""
    copy = F.row_number().over(W.partitionBy("conv_id", "seq").orderBy("role", "text")).cast("string")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("seq"), "role", "text").withColumn(
        "message", F.concat_ws(":", "seq", F.lpad(copy, 10, "0")))
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{delta}}}"), F.lit(0))
    events = F.concat(F.array(F.lit(None).cast("string")), pieces)
    out = rows.select("conv_id", "seq", "message", "role", F.posexplode(events).alias("step", "piece"))
    return out.select("conv_id", "seq", "step", F.when(F.col("step") == 0, "start").otherwise("delta").alias("event"), "message",
                      F.when(F.col("step") == 0, F.col("role")).alias("role"), F.col("piece").alias("text"))


def _ordered(log: DataFrame) -> DataFrame:
    """The log's columns, and its order as ``at``."""
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(FIRST))
    return log.select(*LOG, F.struct(seq.alias("seq"), F.coalesce(F.col("step").cast("long"), F.lit(FIRST)).alias("step")).alias("at"))


def discarded(log: DataFrame) -> DataFrame:
    """``conv_id, message`` of the messages that a regeneration discards. Reads no texts.

    A message is discarded if a later regeneration belongs to a message that started before it: the smallest start among the messages regenerated after a
    place decides. Minima of whole stretches of a conversation's log are carried backwards, so that a stretch is looked at on its own.
    """
    moves = _ordered(log).filter(F.col("event").isin("start", "regenerate")).groupBy("conv_id", "message").agg(
        F.min(F.when(F.col("event") == "start", F.col("at"))).alias("start"),
        F.collect_set(F.when(F.col("event") == "regenerate", F.col("at"))).alias("again"))
    moves = moves.filter(F.col("start").isNotNull())
    begun = moves.select("conv_id", "message", F.col("start").alias("at"), F.lit(None).cast(moves.schema["start"].dataType).alias("back"))
    rows = begun.unionAll(moves.select("conv_id", "message", F.explode("again").alias("at"), F.col("start").alias("back")))
    rows = rows.withColumn("stretch", F.floor(F.col("at.seq") / STRETCH))
    later = W.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(W.unboundedPreceding, -1)
    carried = rows.groupBy("conv_id", "stretch").agg(F.min("back").alias("least")).select(
        F.col("conv_id").alias("_conv"), F.col("stretch").alias("_stretch"), F.min("least").over(later).alias("beyond"))
    after = W.partitionBy("conv_id", "stretch").orderBy(F.desc("at")).rangeBetween(W.unboundedPreceding, W.currentRow)
    seen = rows.withColumn("near", F.min("back").over(after)).join(
        carried, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("stretch").eqNullSafe(F.col("_stretch")), "left")
    gone = F.least("near", "beyond") < F.col("at")
    return seen.filter(F.col("back").isNull() & gone).select("conv_id", "message")


def fold(log: DataFrame) -> DataFrame:
    """``conv_id, at, message, role, text``: the messages that the log leaves, ``at`` being their place in the conversation."""
    entry = F.struct("at", "event", "role", "text")
    told = _ordered(log).filter(F.col("event").isin("start", "delta", "edit", "regenerate")).groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(entry)).alias("events"))
    first = F.get(F.filter("events", lambda e: e["event"] == "start"), F.lit(0))
    reset = F.array_max(F.transform("events", lambda e, i: F.when(e["event"].isin("edit", "regenerate"), i).otherwise(-1)))
    kept = F.filter("events", lambda e, i: (i >= F.col("reset")) & (e["event"] != "regenerate"))
    text = F.array_join(F.transform(kept, lambda e: F.coalesce(e["text"], F.lit(""))), "")
    told = told.withColumn("first", first).filter(F.col("first").isNotNull()).withColumn("reset", reset)
    gone = discarded(log).select(F.col("conv_id").alias("_conv"), F.col("message").alias("_message"))
    left = told.join(gone, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("message").eqNullSafe(F.col("_message")), "left_anti")
    return left.select("conv_id", F.col("first.at").alias("at"), "message", F.col("first.role").alias("role"), text.alias("text"))


def render(messages: DataFrame, template: Template = ZEPHYR, part: int = PART) -> DataFrame:
    """``conv_id, stretch, part, n_turns, formatted, loss``: texts in the template, ``loss`` being the spans to learn (``start, length`` in code points).

    The rows of a conversation, in order of ``stretch`` and ``part``, make up its whole text. A part has about ``part`` code points, or one longer turn.
    """
    role, text = F.coalesce("role", F.lit("")), escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(template.other[0]), escaped(role), F.lit(template.other[1]))
    for name, mark in template.heads:
        head = F.when(role == name, F.lit(mark)).otherwise(head)
    turns = messages.select("conv_id", "at", "message", F.floor(F.col("at.seq") / STRETCH).alias("stretch"), role.isin(*template.learnt).alias("learnt"),
                            head.alias("head"), text.alias("body"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(template.tail)))
    ahead = W.partitionBy("conv_id", "stretch").orderBy("at", "message").rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("begin", F.coalesce(F.sum(F.length("turn")).over(ahead), F.lit(0)))
    turns = turns.withColumn("part", F.floor(F.col("begin") / part))
    item = F.struct("begin", "at", "message", "turn", "learnt", F.length("head").alias("skip"), F.length("body").alias("size"))
    parts = turns.groupBy("conv_id", "stretch", "part").agg(F.sort_array(F.collect_list(item)).alias("t"))
    spans = F.transform(F.filter("t", lambda t: t["learnt"]), lambda t: F.struct(
        (t["begin"] - F.col("t")[0]["begin"] + t["skip"]).cast("long").alias("start"), t["size"].cast("long").alias("length")))
    return parts.select("conv_id", "stretch", "part", F.size("t").alias("n_turns"),
                        F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss"))


def turns_of(formatted: str, template: Template = ZEPHYR) -> list[tuple[str, str]]:
    """Role and text of each turn of a rendered part."""
    found = []
    for turn in formatted.split(template.tail)[:-1]:
        for role, head in template.heads:
            if turn.startswith(head):
                found.append((role, unescaped(turn[len(head):])))
                break
        else:
            if not turn.startswith(template.other[0]):
                raise ValueError(f"no head: {turn[:40]!r}")
            role, text = turn[len(template.other[0]):].split(template.other[1], 1)
            found.append((unescaped(role), unescaped(text)))
    return found


def read_back(rendered: DataFrame, template: Template = ZEPHYR) -> DataFrame:
    """``conv_id, stretch, part, n_turns, turns, loss_text, loss_chars, formatted_chars`` of each part, read from its text and mask alone.

    ``turns`` is role, line feed, text and line feed of each turn, ``loss_text`` what lies under the mask, both in UTF-8 and unescaped.
    """
    kept = ["conv_id", "stretch", "part"]
    given = pa.schema([("n_turns", pa.int64()), ("turns", pa.binary()), ("loss_text", pa.binary()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {name: [] for name in given.names}
            for formatted, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                turns = turns_of(formatted, template)
                under = "".join(unescaped(formatted[s["start"]:s["start"] + s["length"]]) for s in loss)
                for name, value in zip(given.names, (len(turns), "".join(f"{r}\n{t}\n" for r, t in turns).encode(), under.encode(), len(under), len(formatted))):
                    made[name].append(value)
            new = as_table(made, given)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new.columns], names=[*kept, *given.names])

    kind = rendered.schema["conv_id"].dataType.simpleString()
    return rendered.select(*kept, "formatted", "loss").mapInArrow(
        rows, f"conv_id {kind}, stretch long, part long, n_turns long, turns binary, loss_text binary, loss_chars long, formatted_chars long")


def digests(parts: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation, from the rows of :func:`read_back`."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, kind = None, None, None

        def closed(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*[(c, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]) for c, s in done]))
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            kind, done = batch.column("conv_id").type, []
            ids = batch.column("conv_id").to_pylist()
            counts = [batch.column(c).to_pylist() for c in ("n_turns", "loss_chars", "formatted_chars")]
            for i, conv in enumerate(ids):
                if state is None or conv != current:
                    if state is not None:
                        done.append((current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += counts[0][i]
                state[1].update(batch.column("turns")[i].as_buffer())
                state[2] += counts[1][i]
                state[3].update(batch.column("loss_text")[i].as_buffer())
                state[4] += counts[2][i]
            if done:
                yield closed(done)
        if state is not None:
            yield closed([(current, state)])

    kind = parts.schema["conv_id"].dataType.simpleString()
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "part")
    return ordered.mapInArrow(rows, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_log(log: DataFrame, template: Template = ZEPHYR, part: int = PART) -> DataFrame:
    """The rendered parts of all conversations of a log; see :func:`render`."""
    return render(fold(log), template, part)
