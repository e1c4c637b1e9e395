"""Text feature functions.

Every function maps Columns to a Column and runs wherever the rows are, with
no shuffle.  What reads a whole text word by word (cleaning, word lists,
dictionaries, keywords) is a short Arrow function over a batch of texts that
returns the few facts it found (``per_text``); all else, the scores among it,
is built from Spark's own expressions.

Regex dialect: the original runs Python ``re`` in Unicode mode, where ``\\w``
is any letter, digit or underscore.  Java's ``\\w`` is ASCII, so word
characters are spelled ``[\\p{L}\\p{N}_]``.  A whole-word pattern
``\\b(a|b)\\b`` is the same as "a maximal run of word characters equal to a
or b", which is how word lists are matched here (tokens, then set test).
"""
from __future__ import annotations

import re
import unicodedata
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import constants as K

WORD = r"[\p{L}\p{N}_]"
URL_RE = r"http\S+|www\S+|https\S+"
HASHTAG_RE = r"#(" + WORD + r"+)"
MENTION_RE = r"@(" + WORD + r"+)"
PERCENT_RE = r"(\d+(?:\.\d+)?)\s*%"
CURRENCY_RE = r"\$(\d+(?:,\d{3})*(?:\.\d{2})?)\s*(billion|million|trillion)?"
MONEY_RE = r"(?i)\$\d+(?:,\d{3})*(?:\.\d{2})?(?:\s*(?:billion|million|trillion))?"
# Every character Python's str.strip removes: separators and the control spaces.
NOT_BLANK_RE = r"[^\p{Z}\x09-\x0D\x1C-\x1F\x85]"


def _gate(t: Column, needles, expr: Column, empty: Column) -> Column:
    """Run the (costly) regex ``expr`` only on texts containing one of the
    literal ``needles``; others get ``empty`` (same result, cheaper)."""
    cond = None
    for n in needles:
        c = F.contains(t, F.lit(n))
        cond = c if cond is None else cond | c
    return F.when(cond, expr).otherwise(empty)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark evaluates an expression referenced inside a lambda for every
    element; binding it first keeps array code linear.
    """
    return F.get(F.transform(F.array(value), body), 0)


def per_text(fn, kind: str, arrow: pa.DataType, *cols) -> Column:
    """``fn`` of every row's text (and further ``cols``), in Arrow batches; a
    Column of the Spark type ``kind``, which is ``arrow`` in Arrow.  A Python
    function can't stand inside a lambda: bind the result with ``let``."""
    def run(*batch: pa.Array) -> pa.Array:
        return pa.array([fn(*row) for row in zip(*(b.to_pylist() for b in batch))], arrow)

    def run1(texts: pa.Array) -> pa.Array:
        return run(texts)

    def run2(texts: pa.Array, more: pa.Array) -> pa.Array:
        return run(texts, more)

    return F.arrow_udf({1: run1, 2: run2}[len(cols)], kind)(*[_col(c) for c in cols])


def is_word(c: str) -> bool:
    """A character of [\\p{L}\\p{N}_] (str.isalnum holds for the categories L and N)."""
    return c.isalnum() or c == "_"


def whole_words(t: str, words: list[str]) -> list[str]:
    """The places where one of ``words`` (ASCII) stands as a maximal run of
    word characters, in ASCII letters of either case: as spelled, in order."""
    raw = t.encode()
    low, found = raw.lower(), []          # bytes.lower changes ASCII letters only
    for w in words:
        w = w.encode()
        at = low.find(w)
        while at >= 0:
            end = at + len(w)
            if not is_word(raw[max(at - 4, 0):at].decode(errors="ignore")[-1:]) and not is_word(raw[end:end + 4].decode(errors="ignore")[:1]):
                found.append((at, raw[at:end].decode()))
            at = low.find(w, end)
    return [w for _, w in sorted(found)]


def contained(text, names, kind: str = "string", lower: bool = False) -> Column:
    """Array of the ``names`` found as substrings of the text (of the lower-cased
    text, if ``lower``), in their order; with ``kind`` "int" their places in the list."""
    wanted = list(enumerate(names)) if kind == "int" else [(n, n) for n in names]

    def found(t):
        t = (t or "").lower() if lower else t or ""
        return [x for x, n in wanted if n in t]
    return per_text(found, f"array<{kind}>", pa.list_(pa.int32() if kind == "int" else pa.string()), text)


def _by_frequency(words: list[str] | None) -> list[str]:
    n = Counter(words or ())
    return sorted(n, key=n.get, reverse=True)     # stable: ties stay in order of their first place


def by_frequency(words) -> Column:
    """The different words of an array, most frequent first, ties by first position."""
    return per_text(_by_frequency, "array<string>", pa.list_(pa.string()), words)


def word_tokens(text) -> Column:
    """Maximal runs of word characters, in order."""
    return F.regexp_extract_all(_col(text), F.lit(WORD + "+"), F.lit(0))


def count_char(text, ch: str) -> Column:
    t = _col(text)
    return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))


# ---- B1, B2 ---------------------------------------------------------------

def has_text(text) -> Column:
    """B1: text is not null and holds a character that is not Unicode
    whitespace (tabs, newlines and no-break spaces alone are blank)."""
    return F.coalesce(_col(text).rlike(NOT_BLANK_RE), F.lit(False))


def truncate(text, n: int) -> Column:
    """B2: first ``n`` characters (post 280, alert source / context 200)."""
    return F.substring(_col(text), 1, n)


# ---- T1 -------------------------------------------------------------------

def detect_language(text) -> Column:
    """T1: 'fr' when more distinct French than English markers occur among
    the lower-cased whitespace tokens, else 'en'."""
    toks = F.split(F.lower(F.coalesce(_col(text), F.lit(""))), r"\s+")
    fr = F.size(F.array_intersect(toks, _lit_array(K.FRENCH_MARKERS)))
    en = F.size(F.array_intersect(toks, _lit_array(K.ENGLISH_MARKERS)))
    return F.when(fr > en, F.lit("fr")).otherwise(F.lit("en"))


def language_or_detect(lang, text, force: bool = False) -> Column:
    """Language column with the original's rule: detect only when the given
    language is empty (null counts as 'en', the record default)."""
    l = F.coalesce(_col(lang), F.lit("en"))
    if force:
        return detect_language(text)
    return F.when(l == "", detect_language(text)).otherwise(l)


# ---- T2, T3, T4 -----------------------------------------------------------

SPACES = "[^ \t\n\x0b\f\r]+"      # Java's \\S+
NOT_ASCII = bytes(range(128))      # to be deleted from UTF-8, which leaves the characters beyond ASCII
BLANKED = bytes(c if c > 127 or chr(c).isalnum() or chr(c) in "_.!?,-%$" else 32 for c in range(256))
ASCII = frozenset(map(chr, range(128)))


def beyond_ascii(t: str) -> set[str]:
    """The different characters of ``t`` beyond ASCII."""
    return set() if t.isascii() else set(t.encode().translate(None, NOT_ASCII).decode())


def _unlinked(t: str | None) -> str:
    """Without URLs and mentions; of hashtags the words."""
    t = t or ""
    if "http" in t or "www" in t:
        t = re.sub(f"http{SPACES}|www{SPACES}", "", t)
    if "#" in t:
        t = re.sub(r"#(\w+)", r"\1", t)
    if "@" in t:
        t = re.sub(r"@\w+", "", t)
    return t


def _cleaned(t: str | None) -> str:
    t = _unlinked(t)
    for c in beyond_ascii(t):
        if not c.isalnum():
            t = t.replace(c, " ")
    return b" ".join(t.encode().translate(BLANKED).split()).decode()


def clean_text(text) -> Column:
    """Drop URLs and mentions, keep hashtag words, blank out symbols other
    than . ! ? , - % $, squeeze whitespace."""
    return per_text(_cleaned, "string", pa.string(), text)


def word_count(cleaned) -> Column:
    """Words of cleaned text (single-spaced and trimmed): spaces + 1."""
    c = _col(cleaned)
    return F.when(c == "", F.lit(0)).otherwise(count_char(c, " ") + 1)


def sentence_count(cleaned) -> Column:
    """max(pieces of split on '.', 1) == number of dots + 1."""
    return count_char(cleaned, ".") + 1


def text_counts(text, cleaned) -> Column:
    """struct(length, word_count, char_count, sentence_count)."""
    return F.struct(
        F.coalesce(F.length(_col(text)), F.lit(0)).alias("length"),
        word_count(cleaned).alias("word_count"),
        F.length(_col(cleaned)).alias("char_count"),
        sentence_count(cleaned).alias("sentence_count"),
    )


VOWELS = "aeiouyàâäéèêëîïôöùûüÿœæ"
VOWEL_BYTES = bytes(97 if x in (VOWELS + VOWELS.upper()).encode("cp1252") else 32 for x in range(256))


def _vowel_groups(c: str | None) -> int | None:
    """Runs of vowels; all of them are in code page 1252, one byte each."""
    return None if c is None else len(c.encode("cp1252", "replace").translate(VOWEL_BYTES).split())


# A character of cleaned text as a vowel, a dot, another one, or white space.
KINDS = bytes(97 if chr(c) in VOWELS + VOWELS.upper() else 46 if c == 46 else 32 if BLANKED[c] == 32 else 98 for c in range(128)) + bytes([98]) * 128
FEW = 24        # different characters that are replaced one by one


def _clean_counts(t: str | None) -> dict:
    t = _unlinked(t)
    if odd := beyond_ascii(t):
        kind = {c: "a" if c in VOWELS or c.lower() in VOWELS else "b" if c.isalnum() else " " for c in odd}
        if len(kind) <= FEW:
            for c, k in kind.items():
                t = t.replace(c, k)
        else:
            t = t.translate({ord(c): k for c, k in kind.items()})
    raw = b" " + t.encode().translate(KINDS)
    kinds = np.frombuffer(raw, np.uint8)
    word, vowel = kinds != 32, kinds == 97
    words = int(np.count_nonzero(word[1:] > word[:-1]))
    return {"words": words, "chars": int(np.count_nonzero(word)) + max(words - 1, 0), "sentences": raw.count(b".") + 1,
            "syllables": int(np.count_nonzero(vowel[1:] > vowel[:-1]))}


def clean_counts(text) -> Column:
    """T2 + T3, T4: struct(words, chars, sentences, syllables) of the cleaned
    text, which is not passed on."""
    return per_text(_clean_counts, "struct<words:int,chars:int,sentences:int,syllables:int>",
                    pa.struct([(n, pa.int32()) for n in ("words", "chars", "sentences", "syllables")]), text)


def reading_ease(words, sentences, syllables) -> Column:
    """T4: Flesch reading ease 206.835 - 1.015 w/s - 84.6 syl/w, with
    syllables counted as vowel groups; 50 for empty text."""
    w, s, syl = (_col(c).cast("double") for c in (words, sentences, syllables))
    return let(F.struct(w.alias("w"), s.alias("s"), syl.alias("syl")), lambda p: F.when(p["w"] == 0, F.lit(50.0)).otherwise(
        F.lit(206.835) - F.lit(1.015) * (p["w"] / p["s"]) - F.lit(84.6) * (p["syl"] / p["w"])))


def readability(cleaned) -> Column:
    """T4 of cleaned text."""
    return reading_ease(word_count(cleaned), sentence_count(cleaned), per_text(_vowel_groups, "int", pa.int32(), cleaned))


# ---- T5 -------------------------------------------------------------------

URGENCY_WORDS = [w for g in K.URGENCY_WORD_GROUPS for w in g]
URGENCY_COUNTS = pa.struct([("hits", pa.int32()), ("upper", pa.int32())])
NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
SYMBOL_RUN = re.compile("[" + "".join(K.URGENCY_SYMBOLS) + "]+")


def _urgency_counts(t: str | None) -> dict:
    """Urgency words and symbol runs; upper-case letters."""
    t = t or ""
    hits, upper = len(whole_words(t, URGENCY_WORDS)), len(t.encode().translate(None, NOT_UPPER))
    if not t.isascii():
        hits += len(SYMBOL_RUN.findall(t))
        upper += sum(t.count(c) for c in beyond_ascii(t) if unicodedata.category(c) == "Lu")
    return {"hits": hits, "upper": upper}


def urgency_score(text) -> Column:
    """T5: 0.3 per urgency word or symbol run, + 0.5 x upper-case share,
    + 0.2 per '!', capped at 2."""
    t = F.coalesce(_col(text), F.lit(""))
    counts = per_text(_urgency_counts, "struct<hits:int,upper:int>", URGENCY_COUNTS, text)
    return _urgency(t, counts["hits"], counts["upper"], count_char(t, "!"))


def urgency_of(text, facts: Column) -> Column:
    """T5 from the text's ``words.text_facts``."""
    return _urgency(F.coalesce(_col(text), F.lit("")), facts["urgent"], facts["upper"], facts["exclaims"])


def _urgency(t: Column, hits: Column, upper: Column, exclaims: Column) -> Column:
    caps = upper / F.greatest(F.length(t), F.lit(1))
    raw = F.lit(0.3) * hits + F.lit(0.5) * caps + F.lit(0.2) * exclaims
    return F.least(raw.cast("double"), F.lit(2.0))


# ---- T6-T9: financial entities --------------------------------------------

def percentages(text) -> Column:
    """Every 'n%' number, as double."""
    t = F.coalesce(_col(text), F.lit(""))
    raw = _gate(t, ["%"], F.regexp_extract_all(t, F.lit(PERCENT_RE), F.lit(1)),
                F.array().cast("array<string>"))
    return F.transform(raw, lambda x: x.cast("double"))


def currencies(text) -> Column:
    """(amount, unit) pairs; unit '' when absent."""
    t = F.coalesce(_col(text), F.lit(""))
    none = F.array().cast("array<string>")
    amt = _gate(t, ["$"], F.regexp_extract_all(t, F.lit(CURRENCY_RE), F.lit(1)), none)
    unit = _gate(t, ["$"], F.regexp_extract_all(t, F.lit(CURRENCY_RE), F.lit(2)), none)
    return F.transform(F.arrays_zip(amt.alias("amount"), unit.alias("unit")),
                       lambda z: F.struct(z["amount"].alias("amount"),
                                          F.coalesce(z["unit"], F.lit("")).alias("unit")))


def movements(text) -> Column:
    """up/down verbs as whole words, any case, original spelling kept."""
    return per_text(lambda t: whole_words(t or "", K.MOVEMENT_WORDS), "array<string>", pa.list_(pa.string()), text)


def money_mentions(text, limit: int = 5) -> Column:
    """Full money strings, first ``limit``."""
    t = F.coalesce(_col(text), F.lit(""))
    found = _gate(t, ["$"], F.regexp_extract_all(t, F.lit(MONEY_RE), F.lit(0)),
                 F.array().cast("array<string>"))
    return F.slice(found, 1, limit)


def financial_entities(text) -> Column:
    return F.struct(percentages(text).alias("percentages"),
                    currencies(text).alias("currencies"),
                    movements(text).alias("stock_movements"))


# ---- T10, T11, T23, T24: dictionary tagging --------------------------------

def tag_substrings(text, names, case_sensitive: bool = True, match: str = "substring") -> Column:
    """Names (in dictionary order) found in the text.

    ``match='substring'`` keeps the original behaviour ('war' is found in
    'software'); ``match='word'`` requires whole words.
    """
    names = list(names) if case_sensitive else [n.lower() for n in names]
    if match == "word":
        t = F.coalesce(_col(text), F.lit(""))
        arr, t = _lit_array(names), t if case_sensitive else F.lower(t)
        padded = F.concat(F.lit(" "), F.regexp_replace(t, "[^" + WORD[1:-1] + "]+", " "), F.lit(" "))
        return let(padded, lambda p: F.filter(
            arr, lambda n: F.contains(p, F.concat(F.lit(" "), n, F.lit(" ")))))
    return contained(text, names, lower=not case_sensitive)


def organisations(text) -> Column:
    """T10."""
    return tag_substrings(text, K.ORGANISATIONS)


def places(text) -> Column:
    """T11."""
    return tag_substrings(text, K.PLACES)


def topic_keywords(text, vocabulary=K.TOPIC_VOCABULARY, limit: int = 5) -> Column:
    """Vocabulary terms found in the lower-cased text, first ``limit``
    (original spelling of the term kept)."""
    return topics_at(contained(text, [n.lower() for n in vocabulary], "int", lower=True), vocabulary, limit)


def topics_at(at: Column, vocabulary=K.TOPIC_VOCABULARY, limit: int = 5) -> Column:
    """T23 from the places of the vocabulary's terms in the text."""
    return F.transform(F.slice(at, 1, limit), lambda i: F.get(_lit_array(vocabulary), i))


# What the producer looks for besides organisations, for ``words.text_facts``.
PRODUCER_NAMES = {"topics": ([n.lower() for n in K.TOPIC_VOCABULARY], True), "countries": (K.PRODUCER_COUNTRIES, False)}


def producer_entities(text, tagged=None, companies=K.ORGANISATIONS, countries=None) -> Column:
    """struct(companies, countries, persons) as the feed producer tags it
    (``tagged``, ``countries``: tags already computed for this text)."""
    comp = tag_substrings(text, companies) if tagged is None else tagged
    return F.struct(comp.alias("companies"),
                    (tag_substrings(text, K.PRODUCER_COUNTRIES) if countries is None else countries).alias("countries"),
                    F.array().cast("array<string>").alias("persons"))


# ---- T12: keywords --------------------------------------------------------

def _best_words(k: int, stop_words):
    en = frozenset(stop_words["en"] if stop_words else K.STOP_WORDS_ENGLISH)
    fr = frozenset(stop_words["fr"] if stop_words else K.STOP_WORDS_FRENCH)

    def best(c, lang):
        if c is None:
            return None
        # Most frequent first; only as many words are looked at as are needed.
        stop, out, n = fr if lang == "fr" else en, [], Counter(c.lower().split(" "))
        by: dict[int, list] = {}
        for w, m in n.items():
            if m > 1:
                by.setdefault(m, []).append(w)
        for w in chain(*(by[m] for m in sorted(by, reverse=True)), (w for w, m in n.items() if m == 1)):
            if len(out) >= k:
                break
            if len(w) > 3 and w.isalpha() and w not in stop:
                out.append(w)
        return out
    return best


def top_keywords(cleaned, lang, k: int = 10, stop_words=None) -> Column:
    """The ``k`` most frequent candidate words (lower case, longer than
    3, letters only, not a stop word of the post's language), ties broken by
    first position (a Counter keeps that order)."""
    return per_text(_best_words(k, stop_words), "array<string>", pa.list_(pa.string()), cleaned, lang)


def post_keywords(text, lang, k: int = 10, stop_words=None) -> Column:
    """T2 + T12: ``top_keywords`` of the cleaned text, which is not passed on."""
    best = _best_words(k, stop_words)
    return per_text(lambda t, lang: best(_cleaned(t), lang), "array<string>", pa.list_(pa.string()), text, lang)


# ---- T13-T15 --------------------------------------------------------------

def hashtags(text) -> Column:
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(HASHTAG_RE), F.lit(1))


def mentions(text) -> Column:
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(MENTION_RE), F.lit(1))


def urls(text) -> Column:
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(URL_RE), F.lit(0))


# ---- T22 part: the feature struct -------------------------------------------

def text_features(text, lang, cleaned=None, urgency=None, pcts=None, moves=None,
                  orgs=None) -> Column:
    """All preprocessing features of one post as one struct.
    Pre-computed columns may be passed (see ``with_text_analysis``) so each
    feature is computed once per row; missing ones are derived here."""
    cleaned = clean_text(text) if cleaned is None else _col(cleaned)
    pick = lambda c, f: f(text) if c is None else _col(c)
    return F.struct(
        _col(text).alias("original_text"),
        cleaned.alias("cleaned_text"),
        _col(lang).alias("language"),
        F.coalesce(F.length(_col(text)), F.lit(0)).alias("length"),
        word_count(cleaned).alias("word_count"),
        F.length(cleaned).alias("char_count"),
        sentence_count(cleaned).alias("sentence_count"),
        readability(cleaned).alias("readability_score"),
        pick(urgency, urgency_score).alias("urgency_score"),
        F.struct(pick(pcts, percentages).alias("percentages"),
                 currencies(text).alias("currencies"),
                 pick(moves, movements).alias("stock_movements")).alias("financial_entities"),
        F.struct(pick(orgs, organisations).alias("organizations"),
                 places(text).alias("locations"),
                 money_mentions(text).alias("money")).alias("entities"),
        top_keywords(cleaned, lang).alias("keywords"),
        hashtags(text).alias("hashtags"),
        mentions(text).alias("mentions"),
        urls(text).alias("urls"),
    )
