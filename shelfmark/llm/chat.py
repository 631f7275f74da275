"""Chat formatting with loss masks aligned to token offsets."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.blocks import sorted_groups


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and the strings that may not stand in a text as they are.

    A control string inside a role or text gets a backslash after its first character, one
    more if it has some already; reading back takes one away.
    """

    start: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = (
        "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    learn: tuple[str, ...] = ("assistant",)
    patterns: dict = field(default_factory=dict, compare=False, hash=False)

    def _pattern(self, bars: str) -> re.Pattern:
        if bars not in self.patterns:
            every = (self.start, self.sep, self.end, *self.others)
            self.patterns[bars] = re.compile(
                "|".join(re.escape(c[0]) + rf"\\{bars}" + re.escape(c[1:]) for c in every)
            )
        return self.patterns[bars]

    def escape(self, text: str) -> str:
        return self._pattern("*").sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._pattern("+").sub(lambda m: m[0][0] + m[0][2:], text)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The whole conversation as one string, and the span of each turn's text in it."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            head = f"{self.start}{self.escape(role)}{self.sep}"
            body = self.escape(text)
            parts += (head, body, self.end)
            spans.append((at + len(head), at + len(head) + len(body)))
            at += len(head) + len(body) + len(self.end)
        return "".join(parts), spans

    def parse(self, formatted: str) -> list[tuple[str, str, int, int]]:
        """Role, text, and the text's span, of each turn of a rendered conversation."""
        turns, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.start, at):
                raise ValueError(f"no turn starts at {at}")
            sep = formatted.index(self.sep, at)
            a = sep + len(self.sep)
            b = formatted.index(self.end, a)
            role = formatted[at + len(self.start) : sep]
            turns.append((self.unescape(role), self.unescape(formatted[a:b]), a, b))
            at = b + len(self.end)
        return turns


def loss_mask(
    spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """True for tokens that hold a character of one of the sorted spans.

    Token spans are sorted, so each turn finds its first and last token by binary search.
    """
    mask = np.zeros(len(starts), dtype=bool)
    if spans:
        a, b = np.array(spans, dtype=np.int64).T
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
        for x, y, p, q in zip(first.tolist(), last.tolist(), a.tolist(), b.tolist(), strict=True):
            if q > p:
                mask[x:y] = True
    return mask


def masked_text(
    formatted: str, template: Template, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray
) -> list[str]:
    """Per turn that has masked tokens, the characters of its text that lie under the mask.

    A token that reaches over the edge of a text counts only within it; the tokens that
    together spell one character count it once.
    """
    out = []
    s, e = starts[mask], ends[mask]
    for _, _, a, b in template.parse(formatted):
        x, y = np.searchsorted(e, a, side="right"), np.searchsorted(s, b, side="left")
        parts, at = [], a
        for p, q in zip(s[x:y].tolist(), e[x:y].tolist(), strict=True):
            p, q = max(p, at), min(q, b)
            if q > p:
                parts.append(formatted[p:q])
                at = q
        if parts:
            out.append(template.unescape("".join(parts)))
    return out


@lru_cache(maxsize=2)
def _tokenizer(spec: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec)
    tok.no_truncation()
    tok.no_padding()
    tok.encode_special_tokens = True
    return tok


def format_conversations(
    turns: DataFrame,
    tokenizer_path: str,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: id, ``formatted`` text, token ``ids``, their ``starts`` and
    ``ends`` in it (code points), and ``mask``, true where a token is learnt.

    Rows are ordered by turn; nulls come first, equal turns by role and text, and repeated
    rows stay as turns of their own. A null role or text is empty. Rows without a
    conversation id belong to no conversation and are left out. Other columns are ignored; an
    empty table gives no rows. Conversations are dealt and sorted by Spark and read as a
    stream, so a task holds one conversation at a time. A conversation is what is encoded
    whole, so it is never split over tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = turns.sparkSession.sparkContext.broadcast(f.read())
    rows = turns.select(
        F.col(conv_col).alias("c"),
        F.col(turn_col).alias("t"),
        F.coalesce(F.col(role_col), F.lit("")).alias("r"),
        F.coalesce(F.col(text_col), F.lit("")).alias("x"),
    ).where("c is not null")
    schema = T.StructType(
        [
            T.StructField(conv_col, rows.schema["c"].dataType),
            T.StructField("formatted", T.StringType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("starts", T.ArrayType(T.IntegerType())),
            T.StructField("ends", T.ArrayType(T.IntegerType())),
            T.StructField("mask", T.ArrayType(T.BooleanType())),
        ]
    )

    def run(batches):
        tok = _tokenizer(spec.value)
        out, held = [], 0

        def flush():
            columns = list(zip(*out, strict=True))
            kinds = (None, pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=schema.names
            )

        for (conv,), table in sorted_groups(batches, ["c"]):
            pairs = list(zip(table["r"].to_pylist(), table["x"].to_pylist(), strict=True))
            formatted, spans = template.render(pairs)
            enc = tok.encode(formatted, add_special_tokens=False)
            offsets = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
            learnt = [s for s, (role, _) in zip(spans, pairs, strict=True) if role in template.learn]
            mask = loss_mask(learnt, offsets[:, 0], offsets[:, 1])
            out.append((conv, formatted, enc.ids, offsets[:, 0], offsets[:, 1], mask))
            held += len(formatted)
            if held > 4_000_000:
                yield flush()
                out, held = [], 0
        if out:
            yield flush()

    return rows.repartition("c").sortWithinPartitions("c", "t", "r", "x").mapInArrow(run, schema)


def read_back(
    formatted: DataFrame, template: Template = Template(), conv_col: str = "conv_id"
) -> DataFrame:
    """Digests of what the formatted conversations and their masks say.

    ``n_turns``; ``turns_sha256`` over role, newline, text, newline of each turn;
    ``loss_chars`` and ``loss_sha256`` of all text under the mask; ``formatted_chars``.
    """
    schema = T.StructType(
        [
            formatted.schema[conv_col],
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def row(conv, text, starts, ends, mask):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        parsed = template.parse(text)
        for role, said, _, _ in parsed:
            turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        n = 0
        arrays = np.array(starts, np.int64), np.array(ends, np.int64), np.array(mask, bool)
        for said in masked_text(text, template, *arrays):
            loss.update(said.encode("utf-8", "surrogatepass"))
            n += len(said)
        return conv, len(parsed), turns.hexdigest(), n, loss.hexdigest(), len(text)

    def run(batches):
        names = [conv_col, "formatted", "starts", "ends", "mask"]
        for batch in batches:
            rows = [row(*r) for r in zip(*(batch.column(n).to_pylist() for n in names), strict=True)]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    return formatted.select(conv_col, "formatted", "starts", "ends", "mask").mapInArrow(run, schema)
