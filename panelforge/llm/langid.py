"""Language of documents and of their spans: script ranges, per-word scores, Viterbi with a switching penalty.

The model counts hashed character n-grams of words per language, over at most about ``train_rows`` labelled documents
of each language (chosen by a hash of their id). A word's script leaves the languages that use the script; its score
for a language is the mean log probability of its n-grams times a bounded weight. The best path over a document's words
pays ``penalty`` for each change of language. The language with most letters is the document's, the share its score.

Defined results: null text, or text without a letter, is ``und`` with score 0 and no spans; letters are those of
Unicode, so digits, fractions and circled numbers are none, and marks belong to the word of the letter they follow. A
word in a script that no learned language uses leaves all languages open. Ties go to the language that sorts first. The
labels null and ``und`` teach nothing; with no other label every document is ``und``, and ``keep_identified`` then keeps
those with a letter. Repeated rows are judged alike; texts of any length are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.bpe_tree import _LETTER, BEYOND_LATIN, _field
from panelforge.llm.scratch import returning, text_slices

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: The same pattern for texts up to U+024F, where the standard library's engine is twice as fast.
LATIN_WORD = re.compile(f"[{_LETTER}]+")
ORDERS = (1, 2, 3, 4)
#: Score of a language that does not use the word's script.
EXCLUDED = -1000.0
#: First and last code points of script ranges; a letter in none of them is of script 0.
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("kana", [(0x3040, 0x30FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)]),
    ("hangul", [(0x1100, 0x11FF), (0xAC00, 0xD7AF)]),
]


@functools.cache
def script_bounds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    spans = sorted((a, b, k + 1) for k, (_, ranges) in enumerate(SCRIPTS) for a, b in ranges)
    return tuple(np.array(x) for x in zip(*spans))


def scripts_of(codes: np.ndarray) -> np.ndarray:
    first, last, script = script_bounds()
    at = np.maximum(np.searchsorted(first, codes, side="right") - 1, 0)
    return np.where((codes >= first[at]) & (codes <= last[at]), script[at], 0)


def words_in(text: str | None) -> list[str]:
    """Lower-case words: a letter with the letters and marks that follow."""
    text = (text or "").lower()
    return (WORD if BEYOND_LATIN.search(text) else LATIN_WORD).findall(text)


def word_grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each n-gram, the word it belongs to, and the script of each word's first letter."""
    text = " " + " ".join(words) + " "
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    blank = codes == 32
    word = np.cumsum(blank) - 1
    grams, owners = [], []
    value = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        value = value[:size] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
        if n not in ORDERS:
            continue
        # a blank may only be the first or the last character
        inner = np.cumsum(np.r_[0, blank])
        clean = inner[n - 1 : n - 1 + size] - inner[1 : 1 + size] == 0 if n > 1 else ~blank
        mixed = value * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)
        bucket = (mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)
        at = np.flatnonzero(clean)
        grams.append(bucket[at].astype(np.int64))
        # a gram that starts with the blank before a word belongs to that word
        owners.append(word[at])
    first = np.flatnonzero(blank)[:-1] + 1
    return np.concatenate(grams), np.concatenate(owners), scripts_of(codes[first].astype(np.int64))


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages, log probabilities
    allowed: np.ndarray  # scripts x languages
    penalty: float
    max_chars: int = 1 << 20
    held: int = 0
    known: dict = field(default_factory=dict)
    scores: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """words x languages; languages that a word's script excludes get a large negative score."""
        grams, owner, script = word_grams(words, len(self.table))
        n = len(words)
        count = np.bincount(owner, minlength=n)
        total = np.stack([np.bincount(owner, weights=self.table[grams, k], minlength=n) for k in range(self.table.shape[1])], axis=1)
        mean = total / np.maximum(count, 1)[:, None]
        weight = np.minimum([len(w) for w in words], 12.0)[:, None]
        score = (mean - mean.max(axis=1, keepdims=True)) * weight
        return np.where(self.allowed[script], score, EXCLUDED).astype(np.float32)

    def index(self, words: set) -> None:
        """Take up the words that are not in the store, which is emptied first where it holds ``max_chars``."""
        if self.held > self.max_chars:
            self.known, self.scores, self.held = {}, None, 0
        fresh = [w for w in words if w not in self.known]
        if fresh:
            base = len(self.known)
            self.known.update(zip(fresh, range(base, base + len(fresh))))
            self.held += sum(map(len, fresh))
            made = [self.word_scores(part) for part in _parts(fresh, 1 << 16)]
            self.scores = np.concatenate(made if self.scores is None else [self.scores, *made])

    def path(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best language of each word; rows of ``emissions`` are the words of documents one after the other."""
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        best = np.zeros((len(lengths), emissions.shape[1]))
        origin = np.zeros(len(emissions), dtype=np.int64)
        moved = np.zeros(emissions.shape, dtype=bool)
        for t in range(longest):
            a = active[t]
            at = starts[:a] + t
            if t:
                now = best[:a]
                origin[at] = top = np.argmax(now, axis=1)
                jump = now[np.arange(a), top][:, None] - self.penalty
                moved[at] = jump > now
                np.maximum(now, jump, out=now)
            best[:a] += emissions[at]
        state = np.zeros(len(emissions), dtype=np.int64)
        current = np.argmax(best, axis=1)
        for t in reversed(range(longest)):
            a = active[t]
            at = starts[:a] + t
            state[at] = current[:a]
            current[:a] = np.where(moved[at, current[:a]], origin[at], current[:a])
        return state


def _parts(words: Iterable[str], chars: int):
    """Lists of words of about ``chars`` characters."""
    part, size = [], 0
    for word in words:
        part.append(word)
        size += len(word)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def train(docs: DataFrame, train_rows: int, buckets: int, penalty: float, id_col: str, text_col: str, lang_col: str) -> LanguageModel:
    """Model of the labelled ``docs``: n-gram counts summed by Spark, languages x buckets numbers to the driver."""
    rows = docs.where(F.col(text_col).isNotNull() & (F.col(lang_col) != "und"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy(F.col(lang_col).alias("lang")).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0)), np.zeros((len(SCRIPTS) + 1, 0), dtype=bool), penalty)
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, train_rows / n)))])
    drawn = F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share[F.col(lang_col)] * 1_000_000
    sample = rows.where(drawn).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            grams = {lang: np.zeros(buckets, np.int64) for lang in sorted(set(langs))}
            letters = {lang: np.zeros(len(SCRIPTS) + 1, np.int64) for lang in grams}
            for first, texts in text_slices(batch, 1):
                for lang, text in zip(langs[first:], texts):
                    for words in _parts(words_in(text), 1 << 16):
                        grams[lang] += np.bincount(word_grams(words, buckets)[0], minlength=buckets)
                        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
                        letters[lang] += np.bincount(scripts_of(codes), minlength=len(SCRIPTS) + 1)
            for lang in grams:
                gram, script = np.flatnonzero(grams[lang]), np.flatnonzero(letters[lang])
                keys = np.concatenate([gram, -1 - script])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(np.concatenate([grams[lang][gram], letters[lang][script]]))], names=["lang", "key", "n"])

    counts = sample.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    table, letters = np.zeros((buckets, len(languages))), np.zeros((len(SCRIPTS) + 1, len(languages)))
    column = counts["lang"].map({lang: k for k, lang in enumerate(languages)}).to_numpy(dtype=np.int64)
    key, n = counts["key"].to_numpy(), counts["n"].to_numpy()
    table[key[key >= 0], column[key >= 0]] = n[key >= 0]
    letters[-1 - key[key < 0], column[key < 0]] = n[key < 0]
    table = np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * buckets))
    allowed = letters > 0.01 * letters.sum(axis=0)
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(languages, table, allowed, penalty)


def judge(texts: list, model: LanguageModel) -> list[tuple]:
    """(language, score, spans) of each text."""
    if not model.languages:
        return [("und", 0.0, [])] * len(texts)
    words = [words_in(t) for t in texts]
    model.index(set().union(*words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.fromiter((model.known[w] for ws in words for w in ws), dtype=np.int64, count=lengths.sum())
    sizes = np.fromiter((len(w) for ws in words for w in ws), dtype=np.int64, count=len(flat))
    state = model.path(model.scores[flat], lengths) if len(flat) else flat
    ends = np.cumsum(lengths)
    out = []
    for n, end in zip(lengths.tolist(), ends.tolist()):
        if not n:
            out.append(("und", 0.0, []))
            continue
        own, size = state[end - n : end], sizes[end - n : end]
        letters = np.bincount(own, weights=size, minlength=len(model.languages))
        top = int(np.argmax(letters))
        turns = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        spans = [{"first_word": a, "words": b - a, "lang": model.languages[own[a]]} for a, b in zip(turns.tolist(), [*turns[1:].tolist(), n])]
        out.append((model.languages[top], float(letters[top] / letters.sum()), spans))
    return out


def _model_of(model: LanguageModel):
    """The task's own copy of a broadcast model, so that its store of words goes with the task."""
    return LanguageModel(model.languages, model.table, model.allowed, model.penalty)


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    train_rows: int = 4000,
    buckets: int = 1 << 16,
    penalty: float = 6.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """id_col, lang_pred, score, spans (first word, number of words, language) for each of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(labelled, train_rows, buckets, penalty, id_col, text_col, lang_col))

    def run(batches):
        model = _model_of(shared.value)
        kind = pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            for first, texts in text_slices(batch, 1):
                langs, scores, spans = zip(*judge(texts, model))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=[id_col, "lang_pred", "score", "spans"])

    return docs.select(id_col, text_col).mapInArrow(returning(run), f"{_field(docs, id_col)}, lang_pred string, score double, spans array<struct<first_word:int,words:int,lang:string>>")


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2):
    """Whether crc32 of the id as text leaves ``part``; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def keep_identified(docs: DataFrame, labelled: DataFrame, train_rows: int = 4000, buckets: int = 1 << 16, penalty: float = 6.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all columns, but those without a language; without a letter, where no language was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(train(labelled, train_rows, buckets, penalty, id_col, text_col, lang_col))
    at = docs.columns.index(text_col)

    def run(batches):
        model = _model_of(shared.value)
        for batch in batches:
            for first, texts in text_slices(batch, at):
                keep = [lang != "und" for lang, _, _ in judge(texts, model)] if model.languages else [bool(words_in(t)) for t in texts]
                yield batch.slice(first, len(texts)).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(returning(run), docs.schema)
