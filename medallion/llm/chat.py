r"""Chat formatting from an event log.

A conversation is a log of events, ordered by ``seq``:

* ``message``    starts message ``msg`` with a role and a first text,
* ``delta``      appends streamed text to message ``msg``,
* ``edit``       replaces the text of message ``msg`` and drops all messages after it,
* ``regenerate`` empties message ``msg``, drops those after it, and streams anew.

The log is partitioned by conversation, sorted by sequence and folded into the
final messages, which are then rendered.  Message ids grow in the order in which
the messages of a conversation start.

Template (fixed strings): a user turn is ``[INST] text [/INST]``, an assistant
turn ``<s> text </s>``, a system turn ``<<SYS>> text <</SYS>>``; any other role
is ``[MSG] role [ROLE] text [/MSG]``.  Inside texts a control string gets a
backslash after its first character and a backslash is doubled, so no text can
end or start a turn, and :func:`turns` restores it exactly.  The loss mask
covers the assistant texts.

The rendered conversation is a sequence of pieces, one for each final message,
so that no row ever holds a whole conversation.

Defined cases
* null text: empty; null role: the empty role; null conversation: one of its own;
  null sequence: after all others; ties in sequence: by message, kind, role and text;
* repeated rows are separate events; a second start of a message is a message of its own;
  a message without an id is never changed or dropped; events of a message that never starts are ignored;
* empty table: empty result; texts are kept whole; further columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, scratch

CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[MSG]", "[ROLE]", "[/MSG]"]
_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_OPEN = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|<s> (.*?) </s>|<<SYS>> (.*?) <</SYS>>|\[MSG\] (.*?) \[ROLE\] (.*?) \[/MSG\]",
                   re.DOTALL)

EVENT_SCHEMA = "conv_id long, seq long, msg long, kind string, role string, text string"
PART_SCHEMA = ("conv_id long, seg long, ord long, msg long, started boolean, sealed boolean, role string, text string")
PIECE_SCHEMA = "conv_id long, seg long, ord long, role string, piece string, loss_start long, loss_end long"
SEGMENT = 4096
BATCH_CHARS = 1 << 22


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])


_PARTS, _PIECES = _arrow(PART_SCHEMA), _arrow(PIECE_SCHEMA)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(piece, first, end): the formatted turn and the span of its text under the loss mask (empty: none)."""
    if role in _OPEN:
        left, right = _OPEN[role]
    else:
        left, right = f"[MSG] {escape(role)} [ROLE] ", " [/MSG]"
    body = escape(text)
    first = len(left)
    return left + body + right, first, first + len(body) if role == "assistant" else first


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, unescaped text) of every turn; the strings between turns must be nothing."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        at = m.end()
        k = m.lastindex
        role = {1: "user", 2: "assistant", 3: "system"}.get(k) or unescape(m[4])
        yield role, unescape(m[k])
    if at != len(formatted):
        raise ValueError("text after the last turn")


#: Sequence numbers that a turn takes, and pieces in which its text is streamed.
STEPS = 17
STREAMED = 8
STREAM_CHARS = 64


def events_of(conversations: DataFrame) -> DataFrame:
    """An event log that folds to the given conversations (conv_id, turn, role, text).

    The log is what a chat service would have written.  Each text is streamed: a
    start with its first piece, then deltas (``STREAM_CHARS`` characters or more, at most
    ``STREAMED`` pieces).  By the hash of the turn some messages begin as a draft that
    an edit replaces, and some are answered by a further message before they are
    regenerated, which drops that answer.  The numbers of a conversation's log begin
    at a hash, so that segments cut conversations, messages and drafts anywhere.

    Messages are numbered by turn.  A turn that several rows share, or none, cannot
    be told apart by number: those rows are whole messages without an id.  Turns
    beyond 2^55 in magnitude count as 2^55.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                "role", F.coalesce("text", F.lit("")).alias("text"))
    limit = F.lit(1 << 55)
    at = F.greatest(F.least("turn", limit), -limit)
    rows = rows.withColumns({"at": at, "base": F.pmod(F.xxhash64("conv_id"), F.lit(SEGMENT)) + at * STEPS})
    shared = (rows.where("at is not null").groupBy(F.col("conv_id").alias("c"), F.col("at").alias("t"))
              .agg(F.count("*").alias("n")).where("n > 1").select("c", "t", F.lit(True).alias("shared")))
    rows = rows.join(shared, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("t")), "left")
    size = F.length("text")
    n = F.greatest(F.lit(1), F.least(F.lit(STREAMED), F.ceil(size / STREAM_CHARS).cast("int")))
    width = F.greatest(F.lit(1), F.ceil(size / n).cast("int"))
    pieces_ = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("text"), i * width + 1, width))
    rows = rows.withColumns({"p": pieces_, "how": F.pmod(F.xxhash64("conv_id", "at", F.lit("how")), F.lit(10))})
    msg, draft = F.col("at") * 2, F.concat(F.lit("draft: "), F.col("p")[0])

    def event(step: Column | int, id_: Column, kind: str, role: Column, text: Column) -> Column:
        step = F.lit(step) if isinstance(step, int) else step
        return F.struct((F.col("base") + step).alias("seq"), id_.alias("msg"), F.lit(kind).alias("kind"),
                        role.alias("role"), text.alias("text"))

    def deltas(first: int, texts: Column) -> Column:
        return F.transform(texts, lambda x, i: event(i + first, msg, "delta", F.lit(""), x))
    role, rest = F.col("role"), F.slice("p", 2, STREAMED)
    whole = F.array(event(0, F.lit(None).cast("long"), "message", role, F.col("text")))
    streamed = F.concat(F.array(event(0, msg, "message", role, F.col("p")[0])), deltas(1, rest))
    edited = F.concat(F.array(event(0, msg, "message", role, draft), event(1, msg, "delta", F.lit(""), F.lit(" ...")),
                              event(2, msg, "edit", F.lit(""), F.col("p")[0])), deltas(3, rest))
    again = F.concat(F.array(event(0, msg, "message", role, draft), event(1, msg + 1, "message", F.lit("user"), F.lit("again, please")),
                             event(2, msg + 1, "delta", F.lit(""), F.lit("!")), event(3, msg, "regenerate", F.lit(""), F.lit(""))),
                     deltas(4, F.col("p")))
    log = (F.when(F.col("shared") | F.col("at").isNull(), whole).when(F.col("how") < 6, streamed)
           .when(F.col("how") < 8, edited).otherwise(again))
    return rows.select("conv_id", F.inline(log))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size; ``text`` is the place of the column that counts."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[text]) + 64
        if size > BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def fold_back(events: Iterator[tuple]) -> Iterator[tuple]:
    """Parts of messages from the events of segments, each segment's events from the last to the first.

    An event is (conv_id, seg, msg, kind, role, text).  Going backwards, it is
    known when a message starts whether a later event drops it and which text
    replaced its own, so only messages whose start is still to come are held.
    A part is (conv_id, seg, ord, msg, started, sealed, role, text): a message,
    or what a segment has for a message that started before it; ``sealed`` if
    nothing earlier counts.  ord grows with time.
    """
    own, cut, waiting, ord_ = None, None, {}, 0

    def leftover() -> Iterator[tuple]:
        for msg, (sealed, texts) in waiting.items():
            if cut is None or msg <= cut:
                yield (*own, ord_ - 1, msg, False, sealed, "", "".join(reversed(texts)))

    for conv, seg, msg, kind, role, text in events:
        if own != (conv, seg):
            if own is not None:
                yield from leftover()
            own, cut, waiting, ord_ = (conv, seg), None, {}, 0
        ord_ -= 1
        if msg is not None and cut is not None and msg > cut:
            if kind == "message":
                waiting.pop(msg, None)
            continue
        if kind == "message":
            sealed, texts = waiting.pop(msg, (False, [])) if msg is not None else (False, [])
            if not sealed:
                texts.append(text)
            yield conv, seg, ord_, msg, True, sealed, role, "".join(reversed(texts))
        elif msg is not None:
            sealed, texts = waiting.get(msg, (False, []))
            if kind == "delta":
                if not sealed:
                    texts.append(text)
            else:
                if not sealed:
                    texts.append(text)
                sealed = True
                cut = msg if cut is None else min(cut, msg)
            waiting[msg] = (sealed, texts)
    if own is not None:
        yield from leftover()


def _joined(parts: Iterator[tuple]) -> Iterator[tuple]:
    """Messages from the parts of messages, those of one message in order of time."""
    own, head, texts = None, None, []
    for conv, seg, ord_, msg, started, sealed, role, text in parts:
        if started:
            if head is not None:
                yield (*head, "".join(texts))
            own, head, texts = (conv, msg), (conv, seg, ord_, msg, True, False, role), [text]
        elif head is not None and own == (conv, msg):
            texts = [text] if sealed else [*texts, text]
    if head is not None:
        yield (*head, "".join(texts))


def messages(events: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Final messages (conv_id, seg, ord, msg, role, text) of an event log, in the order of (seg, ord).

    A long conversation is cut into segments of ``segment`` sequence numbers
    that are folded apart; a segment's drops reach the ones before it by a
    minimum over the later segments, and texts that run across a cut are joined
    by message.
    """
    seg = F.coalesce(F.floor(F.col("seq") / segment).cast("long"), F.lit(1 << 62))
    log = events.select(F.col("conv_id").cast("long").alias("conv_id"), seg.alias("seg"), "seq", "msg", "kind",
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rank = F.array_position(F.array(*[F.lit(k) for k in ("message", "edit", "regenerate", "delta")]), F.col("kind"))
    back = (log.repartition("conv_id", "seg")
            .sortWithinPartitions("conv_id", "seg", F.col("seq").desc_nulls_first(), F.col("msg").desc_nulls_first(),
                                  rank.desc(), F.col("role").desc(), F.col("text").desc())
            .select("conv_id", "seg", "msg", "kind", "role", "text"))
    parts = scratch(map_arrow(back, lambda b: _batches(fold_back(_rows(b)), _PARTS, 7), PART_SCHEMA), "chat-parts")
    segs = log.groupBy("conv_id", "seg").agg(
        F.min(F.when(F.col("kind").isin("edit", "regenerate"), F.col("msg"))).alias("cut"))
    later = Window.partitionBy("conv_id").orderBy(F.col("seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    drops = (segs.withColumn("later_cut", F.min("cut").over(later)).where("later_cut is not null")
             .select(F.col("conv_id").alias("c"), F.col("seg").alias("s"), "later_cut"))
    alive = (parts.join(drops, parts["conv_id"].eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s")), "left")
             .where("msg is null or later_cut is null or msg <= later_cut").select(*parts.columns))
    loose = parts.where(~F.col("started")).select(F.col("conv_id").alias("c"), F.col("msg").alias("m")).distinct()
    if loose.isEmpty():
        whole = alive
    else:
        on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg") == F.col("m"))
        torn = (alive.join(loose, on, "left_semi").repartition("conv_id", "msg")
                .sortWithinPartitions("conv_id", "msg", "seg", "ord"))
        whole = alive.join(loose, on, "left_anti").unionByName(
            map_arrow(torn, lambda b: _batches(_joined(_rows(b)), _PARTS, 7), PART_SCHEMA))
    return whole.where("started").select("conv_id", "seg", "ord", "msg", "role", "text")


def pieces(final: DataFrame) -> DataFrame:
    """(conv_id, seg, ord, role, piece, loss_start, loss_end): rendered messages; a conversation is its pieces in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rendered() -> Iterator[tuple]:
            for conv, seg, ord_, role, text in _rows(batches):
                yield conv, seg, ord_, role, *render(role, text)
        return _batches(rendered(), _PIECES, 4)

    return map_arrow(final.select("conv_id", "seg", "ord", "role", "text"), run, PIECE_SCHEMA)


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from the pieces: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The pieces of a conversation pass through one task in order; only hash
    states are kept, so its length does not matter.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        own, state, rows = None, None, []
        for b in batches:
            for conv, piece, first, end in zip(*(b.column(i).to_pylist() for i in range(4))):
                if state is None or conv != own:
                    if state is not None:
                        rows.append((own, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    own, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in turns(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(piece[first:end])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(piece)
            if rows:
                yield batch(rows)
                rows = []
        if state is not None:
            yield batch([(own, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])])

    in_order = (rendered.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "ord")
                .select("conv_id", "piece", "loss_start", "loss_end"))
    return map_arrow(in_order, run, schema)
