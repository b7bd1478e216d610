"""Token counts with a whole-token shortcut.

For a byte-level BPE file the library cuts a text into pre-tokens and merges each alone. Offline, every vocabulary
string is encoded alone; those that give one token are proved to count one wherever they are a pre-token. Documents
are cut by the file's published pattern, pre-tokens in that set count one directly, and the library merges each
different other pre-token. Texts that hold a special string go to the library whole.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, tidy

KEPT = 600_000


class Counter:
    """Counts tokens of texts as one tokenizers file gives them."""

    known: dict[str, "Counter"] = {}

    def __init__(self, path: str, pattern: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        # A normalizer, another pre-tokenizer or an added blank would make pieces depend on more than the pattern.
        self.plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.cut = regex.compile(pattern or public_tokenizers.PATTERN).findall
        self.one = self.whole_tokens() if self.plain else {}
        self.seen: dict[str, int] = dict(self.one)

    def whole_tokens(self) -> dict[str, int]:
        """Vocabulary strings that the library gives back as one token when they stand alone."""
        texts = [t for i in range(self.tokenizer.get_vocab_size(with_added_tokens=False)) if (t := self.tokenizer.decode([i], skip_special_tokens=False)) and "�" not in t and t not in self.special]
        return {t: 1 for t, e in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True) if len(e.ids) == 1 and self.cut(t) == [t]}

    @classmethod
    def of(cls, path: str) -> "Counter":
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def counts(self, texts: list[str]) -> list[int]:
        special = self.special
        cut, seen = self.cut, self.seen
        pieces: list[list[str] | None] = [None if not self.plain or any(s in t for s in special) else cut(t) for t in texts]
        new = list({p for x in pieces if x for p in x if p not in seen})
        if len(seen) + len(new) > KEPT:
            seen.clear()
            seen |= self.one
            new = list({p for x in pieces if x for p in x if p not in seen})
        for a in range(0, len(new), 20_000):
            part = new[a : a + 20_000]
            seen.update(zip(part, (len(e.ids) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True))
        get = seen.__getitem__
        return [self.whole(t) if x is None else sum(map(get, x)) for t, x in zip(texts, pieces, strict=True)]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row; null texts count as empty, repeated rows each get a row."""

    def rows(batches):
        c = Counter.of(tokenizer)
        for b in text_batches(batches, 4_000_000):
            t = pc.fill_null(b.column("text"), "")
            n = pa.array(c.counts(t.to_pylist()), pa.int64())
            yield pa.record_batch([b.column("doc_id"), pc.binary_length(t).cast(pa.int64()), n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(rows), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
