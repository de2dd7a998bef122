"""Token counts under a unigram vocabulary: Aho-Corasick matches, dynamic programming over best score and piece count."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import stage_batched

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 200_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces with their stored scores, in id order; the unknown piece is id 0."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Piece counts of words under a unigram model; remembers the last KEPT_WORDS distinct words.

    The rules are those of the common unigram tokenizer: the best-scoring split
    wins; of splits with equal score up to a position the one whose last piece
    starts first stays; a character without a piece of its own is unknown and
    scores UNKNOWN_PENALTY under the worst piece; neighbouring unknown
    characters are one unknown, which counts its UTF-8 bytes if the vocabulary
    has all 256 byte pieces, and 1 otherwise.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.pieces = {piece for piece, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.letters = {piece for piece in self.pieces if len(piece) == 1}
        # a line break in no piece ends whatever stands before it, so the parts count apart
        self.breaks = self.bytes and not any("\n" in piece for piece in self.pieces)

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        n = self.count(word)
        if len(word) <= 64:
            self[word] = n
        return n

    def count(self, word: str) -> int:
        if self.breaks and "\n" in word:
            return sum(self[part] if part else 0 for part in word.split("\n")) + word.count("\n")
        n = len(word)
        if self.letters.issuperset(word):
            reach: list[float | None] = [0.0] + [None] * n
            pieces = [0] * (n + 1)
            for end, (length, score) in self.automaton.iter(word):
                a = end + 1 - length
                s, b = reach[a] + score, reach[end + 1]
                if b is None or s > b:
                    reach[end + 1], pieces[end + 1] = s, pieces[a] + 1
            return pieces[n]
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        open_unknown = [-1] * (n + 1)  # start of the run of unknown characters that ends here
        best[0] = 0.0
        done = 0  # positions up to here are final

        def settle(upto: int) -> None:
            """Unknown characters of positions that no match closed or improved."""
            nonlocal done
            while done < upto:
                a, b = done, done + 1
                if word[a] not in self.pieces:
                    score = best[a] + self.unknown
                    if best[b] is None or score > best[b]:
                        start = open_unknown[a] if open_unknown[a] >= 0 else a
                        best[b], open_unknown[b] = score, start
                        before = count[start]
                        count[b] = before + self._unknown_tokens(word[start:b])
                done += 1

        for end, (length, score) in self.automaton.iter(word):
            end += 1
            settle(end - 1)
            a = end - length
            s = best[a] + score
            if best[end] is None or s > best[end]:
                best[end], count[end], open_unknown[end] = s, count[a] + 1, -1
        settle(n)
        return count[n]

    def _unknown_tokens(self, run: str) -> int:
        if run in self.pieces:
            return 1
        return len(run.encode()) if self.bytes else 1


_counters: dict[str, Counter] = {}


def text_counts(texts: list[str | None], counter: Counter) -> list[int]:
    """Tokens per text. Spaces become the word mark, every word begins with one, and no piece crosses words."""
    out = []
    for t in texts:
        if not t:
            out.append(0)
            continue
        t = t.replace(MARK, " ")
        words = (t if t[0] == " " else " " + t).split(" ")
        n = 0
        for w in words[1:]:
            n += counter[MARK + w]
        out.append(n)
    return out


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_chars of every whole text; null and empty texts have 0 tokens.

    The vocabulary file is read once and sent to the workers (its size is
    fixed); each worker builds its automaton once and remembers a bounded
    number of words. Every row gives one row; nothing is shuffled.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = docs.schema[id_column].dataType.simpleString()

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(vocabulary)
        if counter is None:
            counter = _counters[vocabulary] = Counter(pieces.value)
        for batch in it:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text_counts(texts, counter), type=pa.int64()), pa.array([len(t or "") for t in texts], type=pa.int64())], [id_column, "n_tokens", "n_chars"])

    return stage_batched(docs.select(id_column, F.col(text).cast("string")).mapInArrow(count, f"{id_column} {kind}, n_tokens long, n_chars long"))
