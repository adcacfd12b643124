"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted
spans of the assistant's texts are intersected with the sorted token spans by
binary search. The turn marks are special tokens of their own, so no token
crosses the border of a text and the mask covers each assistant text exactly.

A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>\\n``. Inside a role or a
text every ``<`` + n backslashes + ``|`` gets one backslash more, so no control
string of the template (or of the vocabulary) survives in a text, and taking
one backslash away restores it exactly.

Defined results: a null text or role is empty; turns go by ``turn``, then role
and text, so ties and repeated rows have one order; a null ``conv_id`` is one
conversation; an empty text has no tokens; an empty table gives no rows; other
columns are ignored. One conversation is one string, as its format asks.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEP, END)

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(SEP) + r"(.*?)" + re.escape(END) + "\n", re.S)

FORMAT_SCHEMA = ("conv_id long, formatted string, n_turns long, ids binary, starts binary, ends binary, mask binary")
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, n_tokens long, loss_tokens long")

_WORKER: dict = {}


def escape(text: str) -> str:
    """``text`` without any ``<|``."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    """The inverse of ``escape``."""
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted spans of the assistant's
    (escaped) texts in it, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        role, text = escape(role or ""), escape(text or "")
        head = f"{START}{role}{SEP}"
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(text)))
        at += len(text) + len(END) + 1
        parts.append(f"{head}{text}{END}\n")
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, unescaped."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for tokens that share characters with a span. Starts and ends ascend
    (tokens of one character share its offsets), so each span is a run of
    tokens, found by binary search."""
    mask = np.zeros(len(starts), dtype=np.uint8)
    if spans:
        lo = np.searchsorted(ends, [a for a, _ in spans], side="right")
        hi = np.searchsorted(starts, [b for _, b in spans], side="left")
        for a, b, (s, e) in zip(lo, hi, spans):
            if s < e:
                mask[a:b] = 1
    return mask


def masked_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text under each run of masked tokens, unescaped."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
    return [unescape(formatted[int(starts[a]):int(ends[b - 1])]) for a, b in zip(edges[::2], edges[1::2])]


def chat_tokenizer(path: str):
    """The tokenizer of ``path`` with the template's marks as special tokens
    and offsets that keep white space."""
    if path not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer, pre_tokenizers
        tok = Tokenizer.from_file(path)
        tok.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in CONTROL])
        tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False)
        _WORKER[path] = tok
    return _WORKER[path]


def _format_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = chat_tokenizer(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                rendered = [render([(t["role"], t["text"]) for t in turns]) for turns in part.column("turns").to_pylist()]
                out: dict[str, list] = {k: [] for k in ("formatted", "n_turns", "ids", "starts", "ends", "mask")}
                encoded = tok.encode_batch([f for f, _ in rendered], add_special_tokens=False)
                for (text, spans), enc in zip(rendered, encoded):
                    offsets = np.array(enc.offsets, dtype="<i4").reshape(-1, 2)
                    starts, ends = offsets[:, 0], offsets[:, 1]
                    out["formatted"].append(text)
                    out["n_turns"].append(text.count(START))
                    out["ids"].append(np.array(enc.ids, "<u4").tobytes())
                    out["starts"].append(starts.tobytes())
                    out["ends"].append(ends.tobytes())
                    out["mask"].append(token_mask(starts, ends, spans).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(out["formatted"], pa.string()), pa.array(out["n_turns"], pa.int64()),
                     *[pa.array(out[k], pa.binary()) for k in ("ids", "starts", "ends", "mask")]],
                    names=["conv_id", "formatted", "n_turns", "ids", "starts", "ends", "mask"])
    return run


def format_conversations(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id, turn, role, text``):
    ``formatted``, token ``ids`` (uint32), their ``starts`` and ``ends`` (int32
    code points) and the loss ``mask`` (a byte a token), as little-endian arrays."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long"), F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    slim = whole.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
                        .alias("turns"))
    return slim.mapInArrow(_format_batches(tokenizer), FORMAT_SCHEMA)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                                 "formatted_chars", "n_tokens", "loss_tokens")}
        for r in batch.select(["formatted", "starts", "ends", "mask"]).to_pylist():
            turns = parse(r["formatted"])
            starts, ends = np.frombuffer(r["starts"], "<i4"), np.frombuffer(r["ends"], "<i4")
            mask = np.frombuffer(r["mask"], np.uint8)
            loss = "".join(masked_texts(r["formatted"], starts, ends, mask))
            rows["n_turns"].append(len(turns))
            rows["turns_sha256"].append(hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())
            rows["loss_chars"].append(len(loss))
            rows["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
            rows["formatted_chars"].append(len(r["formatted"]))
            rows["n_tokens"].append(len(mask))
            rows["loss_tokens"].append(int(mask.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(rows["n_turns"], pa.int64()), pa.array(rows["turns_sha256"], pa.string()),
             pa.array(rows["loss_chars"], pa.int64()), pa.array(rows["loss_sha256"], pa.string()),
             *[pa.array(rows[k], pa.int64()) for k in ("formatted_chars", "n_tokens", "loss_tokens")]],
            names=["conv_id", *rows])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted output holds, parsed from it."""
    return formatted.select("conv_id", "formatted", "starts", "ends", "mask").mapInArrow(_digest_batches, DIGEST_SCHEMA)
