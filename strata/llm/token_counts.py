"""Token counts of a SentencePiece BPE model, by a two-tier lookup on the map side.

No piece of the model has a mark for white space after another character, and many pairs
of neighbouring characters are in no piece at all. Between such a pair no merge can ever
happen, so a text falls into pre-tokens that are encoded one by one, and the count of a
text is the sum over its pre-tokens. ``Counter`` derives those pairs from the model.

* Tier 1 is a table pre-token -> length of the most frequent ones, counted over all
  documents: a task counts its own and reports its largest ``PER_TASK``, the reports are
  added up, and the ``TABLE`` largest are encoded and broadcast. Both are fixed numbers,
  so the table has a few MB however large the corpus. It decides speed only.
* Tier 2 is a cache in each worker, of bounded size, for what tier 1 does not have.

Pre-tokens are never shuffled; only the reports are.
"""

from __future__ import annotations

import re
from collections import Counter as Tally
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import parts, texts

PER_TASK = 4_096
TABLE = 65_536
CACHE = 400_000  # entries of a worker's cache
TALLY = 1_000_000  # entries of a task's tally before rare ones are dropped
LONGEST = 64  # characters of what is cached

_SEGMENT = re.compile("▁*[^▁\n]+|▁+|\n")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Counter:
    """Token counts of whole texts; ``known`` is tier 1, the rest is cached."""

    def __init__(self, path: str, known: dict[str, int] | None = None):
        self.model = _model(path)
        m = self.model
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())
                  if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        if any(a != "▁" and b == "▁" for a, b in pairs) or any("\n" in p for p in pairs):
            raise ValueError("pieces of this model cross words or lines")
        # Characters after which a full stop or a comma begins a new pre-token.
        self._stop = {c: {p[0] for p in pairs if p[1] == c} for c in ".,"}
        self.words = _Words(self, dict(known or {}))
        self.parts = _Parts(self)

    def raw(self, part: str) -> int:
        """Tokens of a part that begins with no added mark: the line break before it is one
        token, the mark before that another, and neither merges with what follows."""
        return len(self.model.encode_as_ids("\n" + part)) - 2

    def part(self, part: str) -> int:
        if len(part) > 1 and part[-1] in self._stop and part[-2] not in self._stop[part[-1]]:
            return self.parts[part[:-1]] + self.parts[part[-1]]
        return self.raw(part)

    def count(self, text: str) -> int:
        if not text:
            return 0
        total, first = 0, True
        for row in text.split("\n"):
            if not first:
                total += 1
            if row == "":
                total += 1 if first else 0  # the mark at the beginning of the text
            elif "▁" in row or "  " in row or row[0] == " " or row[-1] == " ":
                marked = row.replace(" ", "▁")
                total += sum(map(self.parts.__getitem__, _SEGMENT.findall("▁" + marked if first else marked)))
            else:
                words = row.split(" ")
                if first:
                    total += sum(map(self.words.__getitem__, words))
                else:
                    total += self.parts[words[0]] + sum(map(self.words.__getitem__, words[1:]))
            first = False
        return total


class _Words(dict):
    """Word -> tokens of the word with a mark before it."""

    def __init__(self, owner: Counter, known: dict[str, int]):
        super().__init__(known)
        self.owner, self.known = owner, known

    def __missing__(self, word: str) -> int:
        n = self.owner.part("▁" + word)
        if len(word) <= LONGEST:
            if len(self) >= CACHE + len(self.known):
                self.clear()
                self.update(self.known)
            self[word] = n
        return n


class _Parts(dict):
    def __init__(self, owner: Counter):
        super().__init__()
        self.owner = owner

    def __missing__(self, part: str) -> int:
        n = self.owner.part(part)
        if len(part) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[part] = n
        return n


def frequent(docs: DataFrame, per_task: int = PER_TASK, table: int = TABLE) -> DataFrame:
    """The most frequent words over all documents, ``word, n``: ``table`` rows at most,
    added up from ``per_task`` rows of each task."""
    def tally(batches):
        seen = Tally()
        for batch in parts(batches):
            for text in batch.column(0).to_pylist():
                seen.update(text.split())
            if len(seen) > TALLY:
                seen = Tally(dict(seen.most_common(TALLY // 4)))
        top = [(w, n) for w, n in seen.most_common(per_task) if n > 1 and len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                                         names=["word", "n"])

    reports = docs.select("text").mapInArrow(tally, "word string, n long")
    return reports.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(table)


def count_tokens(documents: DataFrame, limit: int = 4096, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row (see ``op5``).

    Counts are those of the library for the whole text, without begin, end or added
    special tokens; special strings inside a text are ordinary text, as is its default.
    Null text is empty: no bytes, no tokens. Null or repeated ids give their own rows, an
    empty table none. Other columns are ignored.
    """
    path = path or model_path()
    docs = texts(documents)
    words = [r.word for r in frequent(docs).select("word").collect()]
    counter = Counter(path)
    known = {w: counter.part("▁" + w) for w in words}
    tier_one = documents.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        counter = Counter(path, tier_one.value)
        for batch in parts(batches):
            rows = batch.column("text").to_pylist()
            n = [counter.count(t) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in rows], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
