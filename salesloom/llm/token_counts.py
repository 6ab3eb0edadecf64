"""Token counts by dynamic programming over the trie of distinct pre-tokens.

In sorted order the distinct pre-tokens of a batch are the leaves of their trie,
left to right.  The walk holds the forward scores of the current path only: a
pre-token keeps the scores of the prefix it shares with the one before it and
adds those of its own nodes; the score at its end holds its number of tokens.  A node
looks back by the longest piece, so a word of any length takes time in proportion.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from salesloom.llm.common import column, ship, table
from salesloom.llm.pieces import COUNT, MODEL, PRE_TOKEN, REMEMBERED_LENGTH, Pieces, load

REMEMBERED = 300_000  # pre-tokens whose counts a task keeps between batches; only for speed


def terminal_counts(words: Iterable[str], pieces: Pieces) -> dict[str, int]:
    """Number of tokens on the best path of each distinct word."""
    find, longest = pieces.table.get, pieces.longest
    counts: dict[str, int] = {}
    path: list[int] = [0]  # path[i]: least weight of the first i characters
    before = ""
    for word in sorted(words):
        shared = 0
        for x, y in zip(before, word):
            if x != y:
                break
            shared += 1
        del path[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            one = find(word[end - 1:end])
            best = path[end - 1] + (one[1] if one else pieces.weight_of_bytes(word[end - 1]))
            for start in range(max(0, end - longest), end - 1):
                piece = find(word[start:end])
                if piece is not None:
                    weight = path[start] + piece[1]
                    if weight < best:
                        best = weight
            path.append(best)
        counts[word] = path[-1] % COUNT
        before = word
    return counts


def count_tokens(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_pre_tokens, n_tokens of every row's whole text.

    NULL and empty texts have none; words are counted whole, whatever their length.
    Repeated rows are counted each; other columns are ignored; an empty table gives
    no row.  No shuffle.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    split = re.compile(PRE_TOKEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        known: dict[str, int] = {}
        for batch in batches:
            # some documents at a time: memory follows neither the batch nor the table
            sizes, totals, some, held = [], [], [], 0

            def settle() -> None:
                new = {w for words in some for w in words if w not in known}
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = {w for words in some for w in words}
                known.update(terminal_counts(new, pieces))
                for words in some:
                    sizes.append(len(words))
                    totals.append(sum(map(known.__getitem__, words)))
                some.clear()
                for word in [w for w in new if len(w) > REMEMBERED_LENGTH]:
                    del known[word]

            for text in batch.column(1):
                some.append(split.findall(text.as_py() or ""))
                held += len(some[-1])
                if held > REMEMBERED:
                    settle()
                    held = 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())],
                ["doc_id", "n_pre_tokens", "n_tokens"])

    return docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")
    ).mapInArrow(run, "doc_id long, n_pre_tokens long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of ``documents``."""
    return count_tokens(table(spark, sf_dir, "documents"))
