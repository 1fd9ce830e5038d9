"""Quality rules by divergence from language references.

A document's histogram of character classes and of common words of its language is
compared, by Jensen-Shannon distance, with that language's reference. A reference is a
fixed prior and the sum over documents that pass the base rules; it is summed twice,
the second time over those that are near the first sum, so that junk does not refer to
itself. The prior weighs as much as a few documents: it decides where a language has
hardly any, and vanishes where it has many, so no language goes without a verdict. It
says how letters, digits, white space and marks share a text, and how often the words
of a list come by their rank; which letters a script has comes from the documents.
Both distances count together, as the squares of their shares of a largest distance:
junk is off in both, good short documents scatter widely in one at a time. A comparison
says nothing below a least length; words are compared where the language has a list.

Defined results: a null or empty text has no words and fails the base rules; words are
the runs of other than the six ASCII white-space characters; very long texts are read
whole; a null language is a language of its own, without a list; any row is judged by
itself and its language's reference, so repeated rows get the same verdict, and nothing
is ordered, so ties do not arise; a document at a limit exactly is kept; an empty table
gives no rows. keep_good returns all columns under their names, whatever these are;
score returns the id and its own columns, which replace an id column of their name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.store import join_small, keep_names, materialise, release, scoped
from plinth.llm.words import arrow_map, own_array

#: Least words, and most percent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Least letters and words for the two comparisons.
LEAST_CHARS, LEAST_COMMON_WORDS = 200, 50
#: Largest distances of a document that is kept, each where the other is zero.
MOST_CHARS_APART, MOST_WORDS_APART = 0.30, 0.36
#: Largest distances from the first sum, either of which keeps a document out of the second, and least words for that.
FIRST_CHARS_APART, FIRST_WORDS_APART, FIRST_COMMON_WORDS = 0.30, 0.31, 100
#: What the prior weighs, in characters and words.
PRIOR_CHARS, PRIOR_WORDS = 20_000, 3_000

SYMBOLS = b"#*$%&|<>"
#: Character classes: lower case, upper case, digit, white space, stop, other mark, symbol, beyond ASCII.
CLASSES = 8
# Frequent words of each language, lower case.
COMMON = {
    "en": "the of and to in is that for it as was with be by on not he his but at are this have from or an they which you were a",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so dass kann sie",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más o pero sus le ha este",
}
WORD_BINS = 32  # the most common words of a list, and the last bin for all others


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int8)
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            table[b] = 7
        elif b >= 0x80:
            table[b] = -1  # no character begins here
        elif c.islower():
            table[b] = 0
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 2
        elif b in b" \t\n\v\f\r":
            table[b] = 3
        elif b in b".,;:!?'\"()-":
            table[b] = 4
        elif b in SYMBOLS:
            table[b] = 6
        else:
            table[b] = 5
    return table


_CLASS = _class_table()
LETTERS = (0, 1, 7)
#: The prior's shares: of all letters, of the classes that are none (in order), and of the words of a list.
PRIOR_LETTERS, PRIOR_OTHERS, PRIOR_LISTED = 0.80, {2: 0.01, 3: 0.16, 4: 0.025, 5: 0.005, 6: 0.0}, 0.30
#: How the letters are shared where no document has any.
NO_LETTERS = {0: 0.97, 1: 0.03, 7: 0.0}
_LISTS = {lang: {w.encode(): i for i, w in enumerate(words.split()[: WORD_BINS - 1])} for lang, words in COMMON.items()}
_AROUND = b".,;:!?\"'()"


def repeated_words(ids: np.ndarray, of: np.ndarray, distinct: int, texts: int) -> np.ndarray:
    """For each text, its words that lie in a window of three that it holds twice or more.

    ids number the distinct words, of tells each word's text, in ascending order.
    """
    mark = np.zeros(len(ids), bool)
    at = np.flatnonzero(of[:-2] == of[2:]) if len(ids) > 2 else np.empty(0, np.int64)
    if len(at):
        head = ids[at] * distinct + ids[at + 1]
        if distinct >= 1 << 21:  # numbered anew, else three would not fit 63 bits
            head = np.unique(head, return_inverse=True)[1]
        windows = head * distinct + ids[at + 2]
        order = np.argsort(windows, kind="stable")  # equal windows of one text come to stand together
        windows, at = windows[order], at[order]
        again = np.flatnonzero((windows[1:] == windows[:-1]) & (of[at[1:]] == of[at[:-1]]))
        for first in (at[again], at[again + 1]):
            for i in range(3):
                mark[first + i] = True
    return np.bincount(of[mark], minlength=texts)


def _numbered(parts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of lists of strings, one a text: each string's text and number, and the strings by number."""
    places = np.asarray(parts.offsets)
    coded = parts.flatten().dictionary_encode()
    return np.repeat(np.arange(len(parts)), np.diff(places)), np.asarray(coded.indices, np.int64), coded.dictionary.cast(pa.large_binary()).to_pylist()


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """For each text, its lines with a word that equal an earlier line."""
    of, line, lines = _numbered(pc.split_pattern(texts, "\n"))
    wordy = np.fromiter((bool(x.strip()) for x in lines), bool, len(lines))[line]
    of, line = of[wordy], line[wordy]
    first = np.unique(of * max(len(lines), 1) + line) // max(len(lines), 1)
    return np.bincount(of, minlength=len(texts)) - np.bincount(first, minlength=len(texts))


def classes(texts: pa.Array) -> np.ndarray:
    """For each text, its characters by class."""
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    out = np.zeros((len(texts), CLASSES), np.int64)
    filled = np.flatnonzero(np.diff(places))
    if len(filled):
        of_byte = _CLASS[np.frombuffer(data, np.uint8)[places[0] : places[-1]]]
        for c in range(CLASSES):
            out[filled, c] = np.add.reduceat(of_byte == c, places[filled] - places[0], dtype=np.int64)
    return out


def features(texts: pa.Array, langs: list[str | None]) -> dict[str, np.ndarray]:
    """The counts and the two histograms of texts in an array of their own."""
    n = len(texts)
    of, word, words = _numbered(pc.ascii_split_whitespace(texts))
    there = np.fromiter(map(bool, words), bool, len(words))[word]
    of, word = of[there], word[there]
    chars = classes(texts)
    bins = np.zeros((n, WORD_BINS), np.int64)
    bare = [w.lower().strip(_AROUND) for w in words]
    for lang in {g for g in langs if g in _LISTS}:
        known = _LISTS[lang]
        of_word = np.fromiter((known.get(w, WORD_BINS - 1) for w in bare), np.int64, len(bare))
        own = np.fromiter((g == lang for g in langs), bool, n)[of]
        bins += np.bincount(of[own] * WORD_BINS + of_word[word[own]], minlength=n * WORD_BINS).reshape(n, WORD_BINS)
    return {
        "n_words": np.bincount(of, minlength=n),
        "word_chars": chars.sum(axis=1) - chars[:, 3],
        "n_symbols": chars[:, 6],
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": repeated_words(word, of, max(len(words), 1), n),
        "__p_chars": chars,
        "__p_bins": bins,
    }


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "__p_chars", "__p_bins"]


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())


def measure(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """docs' columns of keep (all but the text unless given) with the counts, __p_lang and the histograms of each text."""
    kept = [c for c in ([x for x in docs.columns if x != text_col] if keep is None else keep) if c.lower() not in NAMES]
    picked = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(lang_col).cast("string").alias("__p_lang"), F.col(text_col).cast("string").alias("__p_text"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = features(own_array(batch.column(len(kept) + 1)), batch.column(len(kept)).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *(_lists(x) if x.ndim == 2 else pa.array(x) for x in found.values())], names=[*kept, "__p_lang", *NAMES])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "__p_text")
    return arrow_map(picked, each, schema + "".join(f", {n} {'array<long>' if n.startswith('__') else 'long'}" for n in NAMES))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def summed(measured: DataFrame, counts: Column) -> DataFrame:
    """One row for each language: __p_lang, ref_docs, and the prior with the histograms of documents that count; ref_bins is null without a list."""
    add = lambda name, n: [F.coalesce(F.sum(F.when(counts, F.get(name, F.lit(i)))), F.lit(0)).alias(f"{name}{i}") for i in range(n)]
    sums = measured.groupBy("__p_lang").agg(F.count_if(counts).alias("ref_docs"), *add("__p_chars", CLASSES), *add("__p_bins", WORD_BINS))
    letters = sum((F.col(f"__p_chars{i}") for i in LETTERS[1:]), F.col(f"__p_chars{LETTERS[0]}"))
    share = lambda i: PRIOR_LETTERS * F.when(letters > 0, F.col(f"__p_chars{i}") / letters).otherwise(NO_LETTERS[i]) if i in LETTERS else F.lit(PRIOR_OTHERS[i])
    ranks = sum(1 / (i + 1) for i in range(WORD_BINS - 1))
    often = [PRIOR_LISTED / (i + 1) / ranks for i in range(WORD_BINS - 1)] + [1 - PRIOR_LISTED]
    bins = F.array(*(F.col(f"__p_bins{i}") + F.lit(PRIOR_WORDS * often[i]) for i in range(WORD_BINS)))
    return sums.select("__p_lang", "ref_docs", F.array(*(F.col(f"__p_chars{i}") + PRIOR_CHARS * share(i) for i in range(CLASSES))).alias("ref_chars"), F.when(F.col("__p_lang").isin(*COMMON), bins).alias("ref_bins"))


def references(measured: DataFrame) -> DataFrame:
    """The prior and the documents that pass the base rules and are near the first reference, that of all that do. measured is read twice."""
    passed = measured.filter(~base_failed())
    first = materialise(summed(passed, F.lit(True)))
    near = (F.coalesce("chars_apart", F.lit(0.0)) <= FIRST_CHARS_APART) & (F.coalesce("words_apart", F.lit(0.0)) <= FIRST_WORDS_APART)
    return summed(compared(passed, first, FIRST_COMMON_WORDS), near)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of histograms row by row; NaN where one is empty."""
    out = np.full(len(a), np.nan)
    some = (a.sum(axis=1) > 0) & (b.sum(axis=1) > 0)
    p, q = (x[some] / x[some].sum(axis=1, keepdims=True) for x in (a, b))
    part = lambda x, m: x * np.log2(np.divide(x, m, out=np.ones_like(m), where=x > 0))
    m = (p + q) / 2
    out[some] = np.sqrt(np.maximum((part(p, m) + part(q, m)).sum(axis=1) / 2, 0))
    return out


def verdicts(found: dict[str, np.ndarray], ref_chars: pa.Array, ref_bins: pa.Array, least_words: int = LEAST_COMMON_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """chars_apart and words_apart, NaN where nothing is compared, and whether the method keeps the row."""

    def apart(own: np.ndarray, refs: pa.Array, where: np.ndarray) -> np.ndarray:
        out = np.full(len(own), np.nan)
        at = np.flatnonzero(where & np.asarray(refs.is_valid()))
        if len(at):
            out[at] = distance(own[at].astype(float), np.asarray(refs.take(pa.array(at)).flatten()).reshape(len(at), -1))
        return out

    chars = apart(found["__p_chars"], ref_chars, found["word_chars"] >= LEAST_CHARS)
    words = apart(found["__p_bins"], ref_bins, found["n_words"] >= least_words)
    return chars, words, ~((np.nan_to_num(chars) / MOST_CHARS_APART) ** 2 + (np.nan_to_num(words) / MOST_WORDS_APART) ** 2 > 1)


def compared(measured: DataFrame, refs: DataFrame, least_words: int = LEAST_COMMON_WORDS) -> DataFrame:
    """measured with chars_apart, words_apart and __p_near, the method's verdict; columns of these names are replaced."""
    new = ["chars_apart", "words_apart", "__p_near"]
    own = measured.drop(*(c for c in measured.columns if c.lower() in new))
    joined = join_small(own, refs.select("__p_lang", "ref_chars", "ref_bins"), ["__p_lang"], F.xxhash64("n_words", "word_chars", "n_repeat_words"), "left")
    names, n = own.columns, len(own.columns)
    where = {c: names.index(c) for c in NAMES}

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = {c: np.asarray(batch.column(i).flatten() if c.startswith("__") else batch.column(i)) for c, i in where.items()}
        for c, width in (("__p_chars", CLASSES), ("__p_bins", WORD_BINS)):
            found[c] = found[c].reshape(-1, width)
        chars, words, near = verdicts(found, batch.column(n), batch.column(n + 1), least_words)
        return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(chars, mask=np.isnan(chars)), pa.array(words, mask=np.isnan(words)), pa.array(near)], names=[*names, *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return arrow_map(joined, each, f"{schema}, chars_apart double, words_apart double, __p_near boolean")


@scoped
def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One narrow row for each document: id, the counts, the distances, base_failed and kept."""
    measured = materialise(measure(docs, text_col, lang_col, [id_col]))
    apart = compared(measured, materialise(references(measured)))
    out = keep_names(apart, {"base_failed": base_failed(), "kept": ~base_failed() & F.col("__p_near")})
    return out.drop("__p_lang", "__p_chars", "__p_bins", "__p_near")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that are kept, with their own columns only. The texts are read twice, and never shuffled."""
    own = docs.toDF(*(f"__p_c{i}" for i in range(len(docs.columns))))
    text, lang = (f"__p_c{docs.columns.index(c)}" for c in (text_col, lang_col))
    measured = materialise(measure(own, text, lang, []))
    refs = materialise(references(measured))
    release(measured)
    names, n, at = own.columns, len(own.columns), own.columns.index(text)
    plain = own.schema[text].dataType.simpleString() == "string"
    marked = own.select("*", F.col(lang).cast("string").alias("__p_lang"), *([] if plain else [F.col(text).cast("string").alias("__p_text")]))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = features(own_array(batch.column(at if plain else n + 1)), batch.column(n).to_pylist())
        few = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
        good = ~few & verdicts(found, *batch.columns[-2:])[2]
        return pa.RecordBatch.from_arrays(batch.columns[:n], names=names).filter(pa.array(good))

    joined = join_small(marked, refs.select("__p_lang", "ref_chars", "ref_bins"), ["__p_lang"], F.xxhash64(text), "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return arrow_map(joined, each, schema).toDF(*docs.columns)
