"""Token counts under a unigram model, shared along a trie of pre-tokens.

A pre-token is a word with the word-start mark in front; punctuation that
follows a letter or digit starts one of its own, without the mark. The distinct
new pre-tokens of a slice of texts form a trie, held as sorted words: in that
order each word shares its longest prefix with the one before, so walking them
is a depth-first walk over the trie. A node stands for a prefix and holds the
best unigram score of any way to cut the prefix into pieces, the tokens of that
way, and the pieces still being spelled there; all follow from the parent alone,
so a prefix is scored once for all words that share it. The node a word ends in
gives its token count, which is kept for later texts.

The public vocabulary ranks its pieces by merge order. Ranks become log
probabilities by Zipf's law, log p = -log(rank + 2.7) - log Z. A character that
no piece spells is less likely than any piece and takes one token for each UTF-8
byte (byte fallback).

Defined results: NULL and empty texts have no words and no tokens. Of equally
likely ways the one with fewer tokens counts, then that with more bytes. The
table of counts starts anew at ``MAX_WORDS``, which bounds memory and changes no
count. The walk keeps one path.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column

from .common import slice_udf

MARK = "▁"
MAX_WORDS = 800_000
COUNTS = "struct<n_words:bigint,n_pretokens:bigint,n_tokens:bigint,n_byte_tokens:bigint>"
_COUNTS = pa.struct([(k, pa.int64()) for k in ("n_words", "n_pretokens", "n_tokens", "n_byte_tokens")])
NOWHERE = -math.inf
_BEFORE_PUNCTUATION = re.compile(rb"(?<=[0-9A-Za-z])(?=[!-/:-@\[-`{-~])")
#: Marks a part that does not start its word; no UTF-8 text has this byte.
_INNER = b"\xff"
#: A count is tokens plus this times the tokens that are bytes.
_BYTE = 1 << 48


@lru_cache(maxsize=4)
def pieces(path: str) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece vocabulary with log probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    total = sum(1 / (rank + 2.7) for rank in range(len(plain)))
    return {model.id_to_piece(i): -math.log(rank + 2.7) - math.log(total) for rank, i in enumerate(plain)}


def pretokens(text: bytes) -> list[bytes]:
    return _BEFORE_PUNCTUATION.sub(b" " + _INNER, text).split()


def spelled(part: bytes) -> str:
    return part[1:].decode() if part.startswith(_INNER) else MARK + part.decode()


class Trie:
    """Scores of pre-tokens over the pieces of a unigram model.

    Pieces form a trie of their own: ``spell`` leads from a piece node and a
    character to a piece node, ``ends`` gives the score where a piece ends.
    """

    def __init__(self, scores: dict[str, float], max_words: int = MAX_WORDS) -> None:
        self.spell: list[dict[str, int]] = [{}]
        self.ends: list[float] = [NOWHERE]
        for piece, score in scores.items():
            at = 0
            for c in piece:
                if c not in self.spell[at]:
                    self.spell[at][c] = len(self.ends)
                    self.spell.append({})
                    self.ends.append(NOWHERE)
                at = self.spell[at][c]
            self.ends[at] = max(self.ends[at], score)
        self.fallback = min(scores.values(), default=0.0) - 10.0
        self.max_words = max_words
        self.known: dict[bytes, int] = {}
        self.nodes = 0

    def walk(self, words: Iterable[str]) -> Iterator[int]:
        """The count of every word; ``words`` are sorted and distinct."""
        spell, ends, fallback = self.spell, self.ends, self.fallback
        # The path: best (score, -tokens, byte tokens) and spellings under way as
        # (piece node, and the best where the piece began), for each depth.
        path = [(0.0, 0, 0)]
        going: list[list[tuple]] = [[]]
        before = ""
        for word in words:
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del path[same + 1 :], going[same + 1 :]
            top, under_way = path[same], going[same]
            for c in word[same:]:
                score, tokens, from_bytes = top
                n = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
                best, more = (score + fallback * n, tokens - n, from_bytes + n), []
                for at, began in (*under_way, (0, top)):
                    on = spell[at].get(c)
                    if on is not None:
                        end = ends[on]
                        if end != NOWHERE and began[0] + end >= best[0]:
                            best = max(best, (began[0] + end, began[1] - 1, began[2]))
                        if spell[on]:
                            more.append((on, began))
                top, under_way = best, more
                path.append(top)
                going.append(more)
            self.nodes += len(word) - same
            before = word
            yield top[2] * _BYTE - top[1]

    def count(self, texts: list[bytes]) -> list[dict[str, int]]:
        parts = [pretokens(t) for t in texts]
        every = set().union(*parts)
        new = [p for p in every if p not in self.known]
        if len(self.known) + len(new) > self.max_words and self.known:
            self.known.clear()
            new = list(every)
        order = sorted((spelled(p), p) for p in new)
        self.known.update(zip((p for _, p in order), self.walk(w for w, _ in order)))
        out = []
        for text, own in zip(texts, parts):
            from_bytes, tokens = divmod(sum(map(self.known.__getitem__, own)), _BYTE)
            out.append({"n_words": len(text.split()), "n_pretokens": len(own), "n_tokens": tokens, "n_byte_tokens": from_bytes})
        return out


@lru_cache(maxsize=2)
def trie(path: str) -> Trie:
    return Trie(pieces(path))


def token_counts(text: Column, vocabulary_path: str) -> Column:
    return slice_udf(lambda part: trie(vocabulary_path).count(part), _COUNTS, COUNTS)(text)
