"""Token counts under a unigram model, over a trie of pre-tokens.

Pre-tokens are white-space-separated words with the vocabulary's word-start mark before them.  A task inserts each distinct
pre-token into a trie.  A trie node holds the forward score of its prefix: the best sum of log-probabilities over all ways to cut
the prefix into vocabulary pieces, and the number of pieces of that way.  It is computed once from the nodes above it, so words
that share a prefix share the work; the terminal node holds the word's count.  A document's count is the sum of
its words' counts.  Nothing is shuffled and no word is hot.

The vocabulary file gives pieces in the order of their rank but no probabilities of a unigram model, so the log-probability of
a piece follows Zipf's law in its rank.  A character that no piece covers costs one token for each of its bytes.

Defined cases: a NULL or empty text, or one of white space, has no words and no tokens.  Of equally good cuts the one with
fewer pieces counts.  Repeated rows count each for themselves.  Texts are read whole.  An input column named like an output is replaced.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tidecast.llm.common import WORD_PATTERN, with_columns

START = "▁"
WORDS = re.compile(WORD_PATTERN)
#: Nodes a task keeps before it starts a new trie, and the log-probability of an uncovered byte.
NODES, BYTE_SCORE = 4_000_000, -20.0


def unigram(path: str) -> dict[str, float]:
    """Log-probability of each piece of a sentencepiece file, by Zipf's law in its rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = sum(1 / (rank + 1) for rank in range(len(pieces)))
    return {p: -math.log((rank + 1) * total) for rank, p in enumerate(pieces)}


class Trie:
    """Forward scores of all prefixes of the words met so far."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        self.clear()

    def clear(self) -> None:
        self.next: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]
        self.terminal: dict[str, tuple[int, float]] = {}

    def insert(self, word: str) -> tuple[int, float]:
        """Pieces and score of the word; walks down the trie and scores only nodes that are new."""
        path, node, whole = [0], 0, START + word
        for end, letter in enumerate(whole, 1):
            child = self.next.get((node, letter))
            if child is None:
                size = len(letter.encode("utf-8", "surrogatepass"))
                best, count = self.score[node] + size * BYTE_SCORE, self.count[node] + size
                for begin in range(max(0, end - self.longest), end):
                    price = self.pieces.get(whole[begin:end])
                    if price is not None:
                        score, parts = self.score[path[begin]] + price, self.count[path[begin]] + 1
                        if score > best or score == best and parts < count:
                            best, count = score, parts
                child = self.next[node, letter] = len(self.score)
                self.score.append(best)
                self.count.append(count)
            node = child
            path.append(node)
        found = self.terminal[word] = (self.count[node], self.score[node])
        return found


def token_counts(docs: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words long``, ``n_tokens long`` and ``log_prob double`` (of the best cuts of all words)."""
    tries: list[Trie] = []

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        if not tries:
            tries.append(Trie(unigram(vocabulary_path)))
        trie, words, tokens, scores = tries[0], [], [], []
        for value in columns[0]:
            found = WORDS.findall(value.as_py() or "")
            if len(trie.score) > NODES:
                trie.clear()
            known = [trie.terminal.get(w) or trie.insert(w) for w in found]
            words.append(len(found))
            tokens.append(sum(k[0] for k in known))
            scores.append(math.fsum(k[1] for k in known))
        return [pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())]

    return with_columns(docs, "n_words long, n_tokens long, log_prob double", run, [text])
