"""Chat formatting by token-level assembly.

Each segment of a turn is encoded by itself and reserved ids are spliced between them, so that no token spans a border
and no text can spell a reserved id. The loss mask is a prefix sum over +1 and -1 marks at the borders of assistant
texts. Control strings in texts are escaped reversibly: a backslash goes in after their first character, beside those
that stand there already.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, lean_batches

#: Reserved strings; their ids follow the vocabulary in this order. Fixed values.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
#: What opens and closes a turn of each role; any other role is spelt out between [ROLE] and [/ROLE].
TURN = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE]", "[/ROLE]", "</s>")
_ESCAPE = re.compile(r"([<\[])(\\*)(?=s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|ROLE\]|/ROLE\])")
_UNESCAPE = re.compile(r"([<\[])(\\*)\\(?=s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|ROLE\]|/ROLE\])")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern of the public byte-level vocabulary. A fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Characters that the splitter is given at a time: runs of a million of one class are too deep for it.
LOT = 1 << 16
#: Where the split pattern always breaks: before a space between two other characters.
_BREAK = re.compile(r"(?<=\S) (?=\S)")


def lots(text: str) -> Iterator[str]:
    """A text in stretches of at most LOT characters, which encode as the whole does: they end where the pattern breaks. A run
    of over LOT characters without such a place, one word or white space alone, is cut within."""
    at = 0
    while len(text) - at > LOT:
        end = at + LOT
        for m in _BREAK.finditer(text, at + 1, at + LOT):
            end = m.start()
        yield text[at:end]
        at = end
    yield text[at:]


def encoded(enc, text: str) -> list[int]:
    return [i for lot in lots(text) for i in enc.encode_ordinary(lot)]


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


@lru_cache(maxsize=2)
def encoder(path: str):
    """(tokenizer, {control string: id})."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    first = max(ranks.values()) + 1
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), {s: first + i for i, s in enumerate(CONTROL)}


def turn_tokens(role: str, text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of one turn."""
    enc, control = encoder(path)
    body = encoded(enc, escape(text))
    if role in TURN:
        segments = [[control[TURN[role][0]]], body, [control[TURN[role][1]]]]
    else:
        segments = [[control[OTHER[0]]], encoded(enc, escape(role)), [control[OTHER[1]]], body, [control[OTHER[2]]]]
    ends = np.cumsum([len(s) for s in segments])
    mark = np.zeros(ends[-1] + 1, np.int8)
    if role == "assistant":
        mark[ends[0]] += 1
        mark[ends[1]] -= 1
    return np.concatenate([np.array(s, np.int32) for s in segments]), np.cumsum(mark[:-1]).astype(np.int8)


def _format(path: str):
    def run(batches):
        for batch in batches:
            ids, masks = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                x, m = turn_tokens(role or "", text or "", path)
                ids.append(x), masks.append(m)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))], names=["conv_id", "turn", "ids", "loss_mask"])

    return run


def format_chat(conversations: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(conv_id, turn, ids, loss_mask): the token ids of each turn, and 1 where an assistant's text stands.

    Turns are encoded where they lie, so that a long conversation is the work of many tasks. Null role or text counts
    as empty; a null conv_id is one more conversation. A repeated row is a turn of its own; texts of any length are
    encoded whole, in stretches (see lots). Extra columns are not read. An empty table gives an empty result.
    """
    lean_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.mapInArrow(_format(path), "conv_id long, turn long, ids array<int>, loss_mask array<tinyint>")


DECODED = "conv_id long, turn long, role string, text string, lost string, chars long"


def _decode(path: str):
    def run(batches):
        enc, control = encoder(path)
        names = {i: s for s, i in control.items()}
        openers = {control[a]: role for role, (a, _) in TURN.items()}
        first = min(names)
        for batch in batches:
            rows = []
            for ids, mask in zip(batch.column("ids"), batch.column("loss_mask"), strict=True):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                at = np.flatnonzero(ids >= first)
                segments = [enc.decode(ids[a + 1 : b].tolist()) for a, b in zip(at, at[1:], strict=False)]
                role = openers.get(int(ids[0]))
                role, text = (unescape(segments[0]), segments[1]) if role is None else (role, segments[0])
                chars = sum(map(len, segments)) + sum(len(names[int(ids[k])]) for k in at)
                rows.append((role, unescape(text), unescape(enc.decode(ids[mask == 1].tolist())), chars))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            types = (pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["conv_id", "turn", "role", "text", "lost", "chars"])

    return run


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches):
    """One row for each conversation from its turns in order, which are held one batch at a time."""
    conv, state = None, None

    def done():
        row = (conv, state["n"], state["turns"].hexdigest(), state["loss"], state["lost"].hexdigest(), state["chars"])
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for c, role, text, lost, chars in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text", "lost", "chars")), strict=True):
            if state is None or c != conv:
                if state is not None:
                    yield done()
                conv, state = c, {"n": 0, "turns": hashlib.sha256(), "loss": 0, "lost": hashlib.sha256(), "chars": 0}
            state["n"] += 1
            state["turns"].update(f"{role}\n{text}\n".encode())
            state["loss"] += len(lost)
            state["lost"].update(lost.encode())
            state["chars"] += chars
    if state is not None:
        yield done()


def read_back(formatted: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Digests of the conversations in formatted token ids, one row for each, turns by number, role and text.

    Turns are decoded where they lie; only their order and the digest over it are one task's work for a conversation.
    """
    rows = formatted.mapInArrow(_decode(path), DECODED).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_digest, READ)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT -1L AS conv_id, t AS turn, IF(t = 0L, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L), (1L) AS v(t)")
    return read_back(cut(format_chat(given.unionByName(own)), "chat"))


OP4_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|ROLE\]|/ROLE\])', '\1\2#\3', 'g'))
                  + CASE role WHEN 'assistant' THEN 7 WHEN 'user' THEN 13 WHEN 'system' THEN 15 ELSE 17 + length(role) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
