"""Token counts: greedy longest-match word pieces, counted in one linear pass over each word.

A trie of the vocabulary holds word-initial pieces under one root and continuing pieces under another. Every
node has a failure link and the number of pieces popped on following it, so a word's count is found without
building a piece and without going back. A word with no cover by pieces counts as one unknown token.

Words are runs other than space and 0x09-0x0D, each kept in a bounded memo of the Python worker. Defined
cases: null, empty and blank texts count 0; repeated rows and ids give a row each; an empty table gives an
empty result; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import mapped, table

MEMO, MEMO_CHARS = 400_000, 48
ROOT, INNER, NOWHERE = 0, 1, -1
_loaded: dict = {}


class Automaton:
    def __init__(self, initial, inner):
        self.next: list[dict[str, int]] = [{}, {}]
        ends, parent = [False, False], [NOWHERE, NOWHERE]
        depth = {ROOT: 0, INNER: 0}
        for root, vocabulary in ((ROOT, initial), (INNER, inner)):
            for piece in vocabulary:
                v = root
                for c in piece:
                    if c not in self.next[v]:
                        self.next[v][c] = len(self.next)
                        depth[len(self.next)] = depth[v] + 1
                        self.next.append({})
                        ends.append(False)
                        parent.append(v)
                    v = self.next[v][c]
                if piece:
                    ends[v] = True
        self.fail, self.popped = [NOWHERE] * len(ends), [0] * len(ends)
        queue = [(c, v) for root in (ROOT, INNER) for c, v in self.next[root].items()]
        for c, v in queue:  # nodes by depth
            u = parent[v]
            if ends[v]:
                self.fail[v], self.popped[v] = INNER, 1
            else:
                z, n = self.fail[u], self.popped[u]
                while z != NOWHERE and c not in self.next[z]:
                    n += self.popped[z]
                    z = self.fail[z]
                if z != NOWHERE:
                    self.fail[v], self.popped[v] = self.next[z][c], n
            queue.extend(self.next[v].items())
        self.memo: dict[str, int] = {}

    def count(self, word: str) -> int:
        """The number of pieces; 0 if the word has no cover."""
        follow, fail, popped = self.next, self.fail, self.popped
        v, n = ROOT, 0
        for c in word:
            while c not in follow[v]:
                if fail[v] == NOWHERE:
                    return 0
                n += popped[v]
                v = fail[v]
            v = follow[v][c]
        while v != INNER:
            if fail[v] == NOWHERE:
                return 0
            n += popped[v]
            v = fail[v]
        return n

    def __call__(self, word: str) -> int:
        n = self.memo.get(word)
        if n is None:
            n = self.count(word)
            if len(word) <= MEMO_CHARS:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[word] = n
        return n


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Word-initial and continuing pieces of a sentencepiece model; control, unknown and byte pieces have no text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in pieces if p[0] == "▁" and len(p) > 1], [p for p in pieces if "▁" not in p]


def automaton(pieces) -> Automaton:
    key = hashlib.sha256(repr(pieces).encode()).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Automaton(*pieces)
    return _loaded[key]


def token_counts(docs: DataFrame, pieces: tuple[list[str], list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_tokens, n_unknown for every row. pieces: word-initial and continuing, broadcast (a vocabulary's size)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pieces)

    def run(batches):
        import pyarrow as pa

        from factloom.llm import wordpiece

        own = wordpiece.automaton(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                counts = list(map(own, map(bytes.decode, (text.as_py() or "").encode().split())))
                unknown = counts.count(0)
                rows.append((len(counts), sum(counts) + unknown, unknown))
            cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [id_col, "n_words", "n_tokens", "n_unknown"])
        own.memo.clear()

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint, n_unknown bigint")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
