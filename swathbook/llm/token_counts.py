"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton over the vocabulary gives all pieces that end at a character; the best path carries its score
and its number of tokens from character to character. Rules of the tokenizer: a space is U+2581, one stands before the
text; where no piece of one character starts, an unknown character may, with a score UNKNOWN below the lowest; of equal
scores, the path whose last piece is longest wins; an unknown character counts its UTF-8 bytes where the vocabulary has
byte pieces, else a run of them counts once. Only the last path positions within the longest piece are kept, so that a
text of any length takes the same memory.

No piece holds a U+2581 after another character, so paths can be cut there: a text's count is the sum of the counts of
its words (with the spaces before them), and each task counts a word once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook.llm.shared import ship_package

SPACE = "▁"
#: Score of an unknown character, below the lowest piece's.
UNKNOWN = 10.0
#: Words whose count a task remembers, and characters of the longest such word.
MEMORY, LONG = 1_000_000, 200
#: Words evaluated at once, and characters of texts that wait for them.
AT_ONCE, WAITING = 8192, 2_000_000
#: From these characters on, UTF-8 takes one byte more.
UTF8_STEPS = [0x80, 0x800, 0x10000]


class UnigramCounter:
    """Counts for the pieces (text, score) of a vocabulary; ``byte_fallback``: unknown characters become bytes."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        import ahocorasick

        self.byte_fallback = byte_fallback
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        # single characters are looked up: thousands of them at the automaton's root would slow every step
        for number, (text, _) in enumerate(pieces):
            if len(text) > 1:
                self.automaton.add_word(text, number)
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()
        self.longest = max([len(t) for t, _ in pieces], default=1)
        self.unknown = min([s for _, s in pieces], default=0.0) - UNKNOWN
        self.chars = {t: s for t, s in pieces if len(t) == 1}
        self.splits = all(SPACE not in t.lstrip(SPACE) for t, _ in pieces)
        self.newline_known = any("\n" in t for t, _ in pieces)
        self.lengths = np.array([len(t) for t, _ in pieces], np.int64)
        self.scores = np.array([s for _, s in pieces], np.float64)
        codes = [ord(c) for c in self.chars]
        self.char_score = np.full(0x110000, self.unknown)
        self.char_score[codes] = list(self.chars.values())
        self.char_tokens = 1 + np.searchsorted(UTF8_STEPS, np.arange(0x110000), "right").astype(np.int8)
        self.char_tokens[codes] = 1
        held = set().union(*[t for t, _ in pieces])
        self.apart = next(c for c in map(chr, range(0x110000)) if c not in held)
        self.known: dict[str, int] = {"": 0}

    def path(self, text: str) -> int:
        """Tokens of the best path through ``text``, which is normalised already."""
        ring = self.longest + 1
        score, count, unknown = [0.0] * ring, [0] * ring, [False] * ring
        matches = iter(()) if self.empty else self.automaton.iter(text)
        ahead = next(matches, None)
        for end in range(len(text)):
            here: list[tuple[int, float]] = []
            while ahead is not None and ahead[0] == end:
                here.append((int(self.lengths[ahead[1]]), float(self.scores[ahead[1]])))
                ahead = next(matches, None)
            best = tokens = None
            is_unknown = False
            for length, value in sorted(here, reverse=True):
                at = (end + 1 - length) % ring
                total = score[at] + value
                if best is None or total > best:
                    best, tokens = total, count[at] + 1
            if text[end] in self.chars:
                total = score[end % ring] + self.chars[text[end]]
                if best is None or total > best:
                    best, tokens = total, count[end % ring] + 1
            else:
                at = end % ring
                total = score[at] + self.unknown
                if best is None or total > best:
                    more = len(text[end].encode("utf-8", "surrogatepass")) if self.byte_fallback else int(not unknown[at])
                    best, tokens, is_unknown = total, count[at] + more, True
            at = (end + 1) % ring
            score[at], count[at], unknown[at] = best, tokens, is_unknown
        return count[len(text) % ring]

    def short(self, words: list[str]) -> np.ndarray:
        """``path`` of many words at once, with byte fallback: the same sums, carried from position to position.

        The automaton runs over all words joined by a character that no piece holds. Steps (a piece, or an unknown
        character) are taken by their end, longest first; of one end and length, a word has one step at most.
        """
        sizes = np.array([len(w) for w in words])
        joined = self.apart.join(words) + self.apart
        starts = np.cumsum(sizes + 1) - sizes - 1
        found = () if self.empty else chain.from_iterable(self.automaton.iter(joined))
        found = np.fromiter(found, np.int64).reshape(-1, 2)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.ones(len(codes), bool)
        inside[starts + sizes] = False
        single = np.flatnonzero(inside)
        ends = np.concatenate([found[:, 0], single])
        length = np.concatenate([self.lengths[found[:, 1]], np.ones(len(single), np.int64)])
        value = np.concatenate([self.scores[found[:, 1]], self.char_score[codes[single]]])
        tokens = np.concatenate([np.ones(len(found), np.int64), self.char_tokens[codes[single]]])
        word = np.searchsorted(starts, ends, "right") - 1
        key = (ends - starts[word] + 1) * (self.longest + 1) + self.longest - length
        order = np.argsort(key, kind="stable")
        key, word, value, tokens = key[order], word[order], value[order], tokens[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]) if len(key) else [0]
        best = np.full((int(sizes.max()) + 1, len(words)), -np.inf)
        count = np.zeros(best.shape, np.int64)
        best[0] = 0.0
        for i, j in pairwise(edges):
            end, rest = divmod(int(key[i]), self.longest + 1)
            at, w = end - self.longest + rest, word[i:j]
            total = best[at, w] + value[i:j]
            better = total > best[end, w]
            w = w[better]
            best[end, w] = total[better]
            count[end, w] = count[at, w] + tokens[i:j][better]
        return count[sizes, np.arange(len(words))]

    def learn(self, words: set[str]) -> None:
        """Add the counts of new words to ``known``."""
        todo = sorted(w for w in words if len(w) <= LONG)  # like beginnings together: the automaton stays in the cache
        for i in range(0, len(todo), AT_ONCE):
            part = todo[i : i + AT_ONCE]
            self.known.update(zip(part, self.short(part).tolist(), strict=True))
        self.known.update((w, self.path(w)) for w in words if len(w) > LONG)

    def words(self, text: str) -> list[str]:
        """Words with the spaces before them, cut at line ends too."""
        if "  " in text or text[0] == " " or SPACE in text:
            return re.findall(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE).replace("\n", " ")).split(" ")

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of whole texts; null and empty texts have none."""
        out: list[int] = []
        if not self.splits or not self.byte_fallback or self.newline_known:
            return [self.path(SPACE + t.replace(" ", SPACE)) if t else 0 for t in texts]
        waiting: list[tuple[int, list[str]]] = []
        new: set[str] = set()
        chars = 0

        def flush() -> None:
            self.learn(new)
            for row, words in waiting:
                out[row] += sum(map(self.known.__getitem__, words))
            if len(self.known) > MEMORY:
                self.known = {"": 0}
            else:
                for w in [w for w in new if len(w) > LONG]:
                    del self.known[w]
            waiting.clear(), new.clear()

        for text in texts:
            if not text:
                out.append(0)
                continue
            words = self.words(text)
            out.append(text.count("\n"))  # a line end that no piece holds is one byte, and ends all paths
            new.update(set(words).difference(self.known))
            waiting.append((len(out) - 1, words))
            chars += len(text)
            if chars >= WAITING:
                flush()
                chars = 0
        flush()
        return out

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]


def read_vocabulary(model: bytes) -> tuple[list[tuple[str, float]], bool]:
    """Pieces and scores of a SentencePiece file, without control, byte, unknown and unused pieces; has byte pieces."""
    from sentencepiece import SentencePieceProcessor

    held = SentencePieceProcessor(model_proto=model)
    ids = range(held.vocab_size())
    plain = [i for i in ids if not (held.is_byte(i) or held.is_control(i) or held.is_unknown(i) or held.is_unused(i))]
    return [(held.id_to_piece(i), held.get_score(i)) for i in plain], any(held.is_byte(i) for i in ids)


@lru_cache(2)
def counter_of(model: bytes) -> UnigramCounter:
    return UnigramCounter(*read_vocabulary(model))


def token_counts(df: DataFrame, model_path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``df`` with the column ``name`` (bigint, replaced if it exists): tokens of each whole text.

    ``model_path`` is a SentencePiece file on the driver; its pieces and scores are read as a unigram vocabulary. The
    file (under a megabyte for 32,000 pieces) is broadcast. Null and empty texts have 0 tokens. Repeated rows get the
    same count, an empty table stays empty, other columns are kept.
    """
    spark = df.sparkSession
    ship_package(spark)
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def count(texts: pa.Array) -> pa.Array:
        counter = counter_of(shared.value)
        return pa.array(counter.counts(t.as_py() for t in texts), pa.int64())

    return df.withColumn(name, F.arrow_udf(count, "long")(text))
