"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A
word's likelihood in a language is the sum, over all ways to cut the word into
pieces, of the products of their probabilities; a forward pass over the word's
positions adds them up. A text's likelihood is the product over its words.
"""

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.llm.rows import held_out, make_room, remembers, sample_per_class
from passerby.session import cut_lineage

UNKNOWN = "und"
#: Learning takes about so many documents of each language, at most twice as many.
LEARN_DOCS = 2000
ROUNDS = 3
#: What a piece counts beside what was seen; a character outside all pieces has this chance of its own.
SMOOTHING = 0.1
STRANGE = 1e-9
#: Word forms that a worker remembers; the memory is emptied when it is full, which changes no result.
REMEMBERED = 200_000
#: Letters are what Unicode has under L, in learning as in scoring: no digits, fractions or circled numbers.
LETTERS = regex.compile(r"\p{L}+")
#: The mark of a word's start in the vocabulary.
START = "▁"


def piece_vocabulary() -> str:
    """Where the public piece vocabulary lies, as the default of the operator's parameter."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def pieces(vocabulary: str) -> dict[str, int]:
    """The vocabulary's pieces of letters, lower-cased, each with its number."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    forms = map(model.id_to_piece, range(model.vocab_size()))
    kept = sorted({form.lower() for form in forms if LETTERS.fullmatch(form.removeprefix(START))} | {START})
    return {form: number for number, form in enumerate(kept)}


class Trie:
    """The vocabulary as arrays: from a state and a character to the next state, and each state's piece."""

    def __init__(self, vocabulary: str):
        known = pieces(vocabulary)
        states = {"": 0}
        for form in sorted(known):
            for end in range(1, len(form) + 1):
                states.setdefault(form[:end], len(states))
        inner = sorted({state[-1] for state in states if len(state) > 1})
        outer = sorted({state for state in states if len(state) == 1} - {*inner})
        #: Number of a code point; 0 stands for all others. Those within pieces come first.
        self.characters = np.zeros(0x110000, np.int32)
        self.characters[[ord(c) for c in inner + outer]] = np.arange(1, len(inner) + len(outer) + 1)
        self.first = np.zeros(len(inner) + len(outer) + 1, np.int32)
        self.next = np.zeros((len(states), len(inner) + 1), np.int32)
        self.piece = np.full(len(states), -1, np.int32)
        for state, number in states.items():
            if len(state) == 1:
                self.first[self.characters[ord(state)]] = number
            elif state:
                self.next[states[state[:-1]], self.characters[ord(state[-1])]] = number
            self.piece[number] = known.get(state, -1)
        #: Places that a piece reaches over, its first included.
        self.reach = max(map(len, known)) + 1

    def spell(self, words: list[str]) -> np.ndarray:
        """A row of characters for each word, with the mark of its start in front and -1 behind its end."""
        sizes = np.array([len(word) for word in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        rows = np.full((len(words), int(sizes.max(initial=0)) + 2), -1, np.int32)
        rows[:, 0] = self.characters[ord(START)]
        column = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        rows[np.repeat(np.arange(len(words)), sizes), column] = self.characters[points]
        return rows

    def walk(self, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """All pieces of all words, by their start: (start, length, words, piece numbers).

        Where no single character is a piece, the character is one of number -1.
        """
        for start in range(rows.shape[1] - 1):
            words = np.flatnonzero(rows[:, start] >= 0)
            state = self.first[rows[words, start]]
            lone = self.piece[state] < 0
            if lone.any():
                yield start, 1, words[lone], np.full(int(lone.sum()), -1)
            length = 1
            while True:
                alive = state > 0
                words, state = words[alive], state[alive]
                if not len(words):
                    break
                number = self.piece[state]
                whole = number >= 0
                if whole.any():
                    yield start, length, words[whole], number[whole]
                letter = rows[words, start + length]
                state = np.where((letter >= 0) & (letter < self.next.shape[1]), self.next[state, np.clip(letter, 0, self.next.shape[1] - 1)], 0)
                length += 1


    def spans(self, row: np.ndarray, first: int, end: int) -> np.ndarray:
        """For each start in a range of one word, the numbers of its pieces by length; `NO_PIECE` where there is none."""
        starts = np.arange(first, min(end, len(row) - 1))
        found = np.full((len(starts), self.reach), NO_PIECE)
        state, alive = self.first[row[starts]], np.arange(len(starts))
        for length in range(1, self.reach + 1):
            number = self.piece[state]
            found[alive, length - 1] = np.where(number >= 0, number, -1 if length == 1 else NO_PIECE)
            letter = row[np.minimum(starts[alive] + length, len(row) - 1)]
            state = np.where((letter >= 0) & (letter < self.next.shape[1]), self.next[state, np.clip(letter, 0, self.next.shape[1] - 1)], 0)
            alive, state = alive[state > 0], state[state > 0]
            if not len(alive):
                break
        return found


trie_of = functools.cache(Trie)
#: Marks a length for which there is no piece.
NO_PIECE = -2
#: A longer word is taken by itself, all its starts together.
LONG = 128


def _weights(trie: Trie, row: np.ndarray, first: int, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the starts of one part of a word, and their chances, 0 where there is no piece."""
    found = trie.spans(row, first, first + PART)
    return found, np.where((found == NO_PIECE)[:, :, None], 0.0, chances[found])


def forward_one(trie: Trie, row: np.ndarray, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`forward` for one word of any length, with a scale for each place."""
    size = len(row) - 1
    total, scale = np.zeros((size + trie.reach + 1, chances.shape[1])), np.zeros((size + 1, chances.shape[1]))
    total[0], level = 1.0, np.zeros(chances.shape[1])
    for first in range(0, size, PART):
        for start, weights in enumerate(_weights(trie, row, first, chances)[1], first):
            if start % BLOCK == 0:
                most = total[start:start + trie.reach].max(axis=0)
                total[start:start + trie.reach] /= most
                level = level + np.log(most)
            scale[start] = level
            total[start + 1:start + 1 + trie.reach] += total[start] * weights
    scale[size] = level
    return total[:size + 1], scale


def expected_one(trie: Trie, row: np.ndarray, chances: np.ndarray, count: float) -> np.ndarray:
    """`expected` for one word of any length."""
    ahead, scale = (values[:, 0] for values in forward_one(trie, row, chances[:, None]))
    size, used = len(row) - 1, np.zeros(len(chances))
    back, levels = np.zeros(size + trie.reach + 1), np.append(scale, np.full(trie.reach, scale[-1]))
    back[size] = count / ahead[size]
    for first in range((size - 1) // PART * PART, -1, -PART):
        found, weights = _weights(trie, row, first, chances[:, None])
        rests = np.zeros(found.shape)
        for at in range(len(found) - 1, -1, -1):
            start = first + at
            after = slice(start + 1, start + 1 + trie.reach)
            rests[at] = back[after] * weights[at, :, 0] * np.exp(levels[start] - levels[after])
            back[start] = rests[at].sum()
        held = found != NO_PIECE
        used += np.bincount(found[held] % len(chances), (ahead[first:first + len(found), None] * rests)[held], len(chances))
    return used[:-1]


#: At every so many places of a word what has been added up is scaled anew, so that no product leaves the range of a double.
BLOCK = 16
#: Starts of a long word whose pieces are looked up together.
PART = 1024


def forward(rows: np.ndarray, steps, chances: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each beginning of each word, by language, all ways of cutting it added up, and the logarithms it is scaled by.

    ``chances`` has a row for each piece and a last one for lone characters; no
    piece is longer than ``reach``. The steps come by their start, so a place is
    complete before it is used. The chance itself is the value times e to the
    power of the scale of the place's block.
    """
    total = np.zeros((*rows.shape, chances.shape[1]))
    total[:, 0] = 1.0
    scale = np.zeros((len(rows), rows.shape[1] // BLOCK + 1, chances.shape[1]))
    block = 0
    for start, length, words, numbers in steps:
        if start >= (block + 1) * BLOCK:
            block += 1
            scale[:, block] = scale[:, block - 1]
            alive = rows[:, start] >= 0
            # What the places from here on have got so far came from before.
            part = total[alive, start:start + reach]
            most = part.max(axis=1)
            total[alive, start:start + reach] = part / most[:, None]
            scale[alive, block] += np.log(most)
        total[words, start + length] += total[words, start] * chances[numbers]
    scale[:, block + 1:] = scale[:, block:block + 1]
    return total, scale


def ends_of(rows: np.ndarray) -> np.ndarray:
    return (rows >= 0).sum(axis=1)


def expected(rows: np.ndarray, trie: Trie, chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each piece is used in one language, over all ways of cutting all words."""
    if rows.shape[1] > LONG:
        return sum(expected_one(trie, row[:ends_of(row[None])[0] + 1], chances, count) for row, count in zip(rows, counts, strict=True))
    ahead, scale = (values[:, :, 0] for values in forward(rows, trie.walk(rows), chances[:, None], trie.reach))
    back, every, ends = np.zeros(rows.shape), np.arange(len(rows)), ends_of(rows)
    back[every, ends] = counts / ahead[every, ends]
    used = np.zeros(len(chances))
    for start, length, words, numbers in reversed(list(trie.walk(rows))):
        rest = back[words, start + length] * chances[numbers] * np.exp(scale[words, start // BLOCK] - scale[words, (start + length) // BLOCK])
        back[words, start] += rest
        used += np.bincount(numbers % len(chances), ahead[words, start] * rest, len(chances))
    return used[:-1]


def _chances(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + SMOOTHING
    return np.append(smoothed / smoothed.sum() * (1 - STRANGE), STRANGE)


#: Words are taken together up to so many characters and languages.
TOGETHER = 1 << 18


def batches_of(words: list[str], wide: int = 1) -> Iterator[list[int]]:
    """Places of words of like length that are taken together; a longer word is taken by itself."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    first = 0
    while first < len(order):
        # Lengths ascend, so the last word taken is the widest.
        last = first + 1
        while last < len(order) and (last + 1 - first) * (len(words[order[last]]) + 2) * wide <= TOGETHER and (
                (len(words[order[first]]) + 2 > LONG) == (len(words[order[last]]) + 2 > LONG)):
            last += 1
        yield order[first:last]
        first = last


def fit_language(words: list[str], counts: np.ndarray, vocabulary: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language, by expectation and maximisation over all segmentations."""
    trie = trie_of(vocabulary)
    parts = list(batches_of(words))
    chances = _chances(np.zeros(len(pieces(vocabulary))))
    for _ in range(rounds):
        chances = _chances(sum(expected(trie.spell([words[i] for i in part]), trie, chances, counts[part]) for part in parts))
    return chances


@dataclass
class Model:
    """Languages, and for each piece and language its probability; about 1 MB for four languages."""

    languages: list[str]
    chances: np.ndarray
    vocabulary: str

    def score(self, words: list[str]) -> np.ndarray:
        """The logarithm of each word's likelihood, by language."""
        trie, out = trie_of(self.vocabulary), np.zeros((len(words), len(self.languages)))
        for part in batches_of(words, len(self.languages)):
            rows = trie.spell([words[i] for i in part])
            if rows.shape[1] > LONG:
                for i, row in zip(part, rows, strict=True):
                    total, scale = forward_one(trie, row[:ends_of(row[None])[0] + 1], self.chances)
                    out[i] = np.log(total[-1]) + scale[-1]
                continue
            total, scale = forward(rows, trie.walk(rows), self.chances, trie.reach)
            every, ends = np.arange(len(rows)), ends_of(rows)
            out[part] = np.log(total[every, ends]) + scale[every, ends // BLOCK]
        return out


def learning_rows(docs: DataFrame) -> DataFrame:
    """Texts that may be learnt from: not held out, with a language and a text."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")


def learn(docs: DataFrame, vocabulary: str | None = None, bound: int = LEARN_DOCS) -> Model:
    """A model of the languages in ``docs``, from about ``bound`` documents of each, whole texts.

    The documents of a language are fitted in one task of its own; their number
    is bounded. The model that comes back has a fixed size per language.
    """
    vocabulary = vocabulary or piece_vocabulary()
    sample = sample_per_class(learning_rows(docs), "lang", "doc_id", bound)
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word"))
    counted = cut_lineage(words.groupBy("lang", "word").count())

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        chances = fit_language(rows["word"].tolist(), rows["count"].to_numpy(float), vocabulary)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "chances": [chances.tolist()]})

    fitted = counted.groupBy("lang").applyInPandas(fit, "lang string, chances array<double>").orderBy("lang").collect()
    if not fitted:
        return Model([], np.zeros((len(pieces(vocabulary)) + 1, 0)), vocabulary)
    return Model([row.lang for row in fitted], np.array([row.chances for row in fitted]).T.copy(), vocabulary)


class Scorer:
    """Adds up the words' likelihoods of texts, remembering those of word forms seen before."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.languages)))

    def _learn(self, forms: set[str]) -> None:
        """Gives each new form a row; the row of a form with one run of letters is that of the run."""
        if len(self.place) + len(forms) > REMEMBERED:
            self.place, self.logs = {}, self.logs[:0]
        runs = {form: [form] if form.isalpha() else LETTERS.findall(form) for form in forms if form not in self.place}
        new = [run for run in {run for parts in runs.values() for run in parts} if run not in self.place]
        several = [form for form, parts in runs.items() if len(parts) != 1 and form not in self.place]
        first = len(self.logs)
        self.logs = np.concatenate([self.logs, self.model.score(new), np.zeros((len(several), len(self.model.languages)))])
        self.place.update(zip(new, range(first, len(self.logs)), strict=False))
        for row, form in enumerate(several, first + len(new)):
            self.logs[row] = self.logs[[self.place[run] for run in runs[form]]].sum(axis=0)
            self.place[form] = row
        for form, parts in runs.items():
            if len(parts) == 1:
                self.place[form] = self.place[parts[0]]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        counts = [Counter(text.lower().split()) if text else Counter() for text in texts]
        self._learn(set().union(*counts))
        found = []
        for text, words in zip(texts, counts, strict=True):
            if not self.model.languages or not text or not LETTERS.search(text):
                found.append((UNKNOWN, 0.0))
                continue
            rows = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            total = np.fromiter(words.values(), float, len(words)) @ self.logs[rows]
            best = int(np.argmax(total))  # ties: the first language by name
            found.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return found


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, replacing columns of these names.

    The score is the predicted language's share of the likelihoods, all
    languages being equally likely beforehand. A text that is null or has no
    letter, and every text under a model without languages, is `und` with score
    0. Ties go to the first language by name. Texts are read whole; repeated
    rows get the same answer; other columns pass through untouched.
    """
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = kept.sparkSession.sparkContext.broadcast(model)
    at = kept.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("language")
        scorer = _scorer(shared.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                answers = scorer.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([lang for lang, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())],
                    [field.name for field in schema.fields])

    return kept.mapInArrow(score, schema)


_scorers: dict[bytes, Scorer] = {}


def _forget() -> None:
    _scorers.clear()
    trie_of.cache_clear()
    pieces.cache_clear()


remembers("language", _forget)


def _scorer(model: Model) -> Scorer:
    """One scorer for each worker process and model."""
    key = model.chances.tobytes()
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learnt from those not held out."""
    model = learn(docs)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


