"""Operator 5: token counts of a unigram vocabulary by count-only Viterbi.

A text is cut before every space (written ``\\u2581``, one is put in front of a text that does not start with it). For each piece of
text an Aho-Corasick automaton lists the vocabulary entries that end at each character; dynamic programming carries the best
score and the number of tokens on that path, never the path. Ties follow the tokenizer: candidates for a position are tried with the
earliest start first and replace the best only if they score higher; a character that is no entry by itself may be an unknown token
with the lowest vocabulary score less 10, which comes last. Unknown characters count one token for each UTF-8 byte if the vocabulary
holds every byte token (``<0x00>`` to ``<0xFF>``), else a run of them counts one.

Pieces of text are remembered, at most two generations of 200,000 in each task.

Defined results: a null or empty text has 0 tokens; repeated rows count alike; only the id and text columns are read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.common import Memo, map_rows

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """(entry, score) of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for entry, score in vocabulary:
            if entry:
                self.automaton.add_word(entry, (len(entry), score))
        if vocabulary:
            self.automaton.make_automaton()
        entries = {e for e, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in entries for b in range(256))
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.memo = Memo(self.piece, 200_000)

    def piece(self, text: str) -> tuple[int, int]:
        """(tokens, unknown characters on the best path) of one piece of text."""
        best, packed, tail = [0.0], [0], [False]  # by position: score, tokens + unknown characters << 32, ends in an unknown run
        top, state, single, at = None, 0, False, 0

        def close():  # settles position at + 1
            nonlocal top, state, single, at
            run = False
            if not single:
                value = self.unknown + best[at]
                if top is None or value > top:
                    new = len(text[at].encode()) if self.bytes else 0 if tail[at] else 1
                    top, state, run = value, packed[at] + new + (1 << 32), True
            best.append(top), packed.append(state), tail.append(run)
            top, single = None, False
            at += 1

        # matches come by end, at each end the longest (the earliest start) first
        for end, (size, score) in self.automaton.iter(text) if len(self.automaton) else ():
            while at < end:
                close()
            start = end + 1 - size
            value = score + best[start]
            if top is None or value > top:
                top, state = value, packed[start] + 1
            if size == 1:
                single = True
        while at < len(text):
            close()
        return packed[-1] & 0xFFFFFFFF, packed[-1] >> 32

    def count(self, text: str | None) -> tuple[int, int]:
        if not text:
            return 0, 0
        parts = text.replace(" ", SPACE).split(SPACE)
        if not parts[0]:
            parts = parts[1:]
        got = [self.memo[SPACE + p] for p in parts]
        return sum(a for a, _ in got), sum(b for _, b in got)


_COUNTERS: dict[int, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_unknown) of every whole text."""
    src = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    key = xxhash.xxh3_64_intdigest(repr(vocabulary).encode())
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a vocabulary, not data

    def start():
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(shared.value)
        counter = _COUNTERS[key]

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [counter.count(t) for t in b.column(1).to_pylist()]
            return pa.record_batch([b.column(0), pa.array([a for a, _ in found], pa.int64()), pa.array([u for _, u in found], pa.int64())],
                                   names=["k", "n_tokens", "n_unknown"])

        return work

    return map_rows(src, start, "k long, n_tokens long, n_unknown long").withColumnRenamed("k", id_col)
