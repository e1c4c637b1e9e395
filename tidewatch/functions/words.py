"""What the words of a text say (T5, T8, T10, T16, T18, T23, T24 in one pass).

A text is cut at white space once, and one pattern over the different words of
a batch tells the few that are looked at.  None of the facts below crosses white space
but names of several words, which are looked for in the text where a word ends
like their first.  The scores are Spark expressions.
"""
from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import text as tx

HIT = "array<struct<v:double,caps:boolean,b1:double,b2:double,b3:double,negated:boolean>>"
HIT_ARROW = pa.list_(pa.struct([("v", pa.float64()), ("caps", pa.bool_()), *[(f"b{d}", pa.float64()) for d in (1, 2, 3)], ("negated", pa.bool_())]))
ASCII_EDGE = "".join(c for c in map(chr, range(128)) if not tx.is_word(c) and c not in " \t\n\x0b\f\r")
SILENT = (False, None, 0.0, False, False, 0, 0, (), (), ())
ONLY_SHORT = (True, *SILENT[1:])


ROWS = 1_024      # texts cut into words at once
# Words that are looked at anyway: of less than two letters, or not of printable ASCII and Latin small letters.
SHORT, ODD = "^[^A-Za-z0-9_ß-öø-ÿ]*[A-Za-z0-9_ß-öø-ÿ]?[^A-Za-z0-9_ß-öø-ÿ]*$", "[^!-~ß-öø-ÿ]"


class WordFacts(dict):
    """word -> what ``look`` says of it; forgotten when there are too many.
    A word in which ``told`` (an RE2 pattern) isn't found says nothing."""
    LIMIT, LONGEST = 20_000, 64

    def __init__(self, look, told: str):
        super().__init__()
        self.look, self.told = look, told

    def __reduce__(self):
        return WordFacts, (self.look, self.told)

    def __missing__(self, word: str):
        if len(self) >= self.LIMIT:
            self.clear()
        said = self.look(word)
        if len(word) <= self.LONGEST:
            self[word] = said
        return said

    def of(self, texts: pa.Array) -> Iterator[tuple[int, list]]:
        """Of every text the number of its words (Java's \\s between) and
        (place, what it says) of those that say something."""
        cut = pc.ascii_split_whitespace(texts)
        ends, coded = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        words, says = coded.dictionary, [0] * len(coded.dictionary)
        at = np.nonzero(pc.match_substring_regex(words, self.told).to_numpy(zero_copy_only=False))[0]
        for k, w in zip(at.tolist(), words.take(pa.array(at)).to_pylist()):
            says[k] = self[w]
        at = np.array([k for k in at.tolist() if says[k]], dtype=np.int64)
        codes, tells = coded.indices.to_numpy(), np.zeros(len(words), dtype=bool)
        tells[at] = True
        at = np.nonzero(tells[codes])[0]
        said = [says[k] for k in codes[at].tolist()]
        cuts, at = np.searchsorted(at, ends).tolist(), at.tolist()
        for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
            start = int(ends[i])
            yield int(ends[i + 1]) - start, [(k - start, f) for k, f in zip(at[a:z], said[a:z])]


def core(w: str) -> str:
    """The word without the punctuation at its ends."""
    return w.strip(ASCII_EDGE if w.isascii() else ASCII_EDGE + "".join(c for c in set(w) - tx.ASCII if not c.isalnum()))


def loud(w: str) -> bool:
    return w == w.upper() and w != w.lower()


def some_small(raw: bytes) -> bool:
    """Not every token of the text is in capitals."""
    while raw:
        words = raw.split(None, 32)
        raw = words.pop() if len(words) > 32 else b""
        if any(len(c) > 1 and not loud(c) for c in (core(w.decode()) for w in words)):
            return True
    return False


def _look(names: list[tuple], weight: dict, boost: dict, negations: frozenset) -> WordFacts:
    """The memory of look(word): 0 if the word says nothing, else (too short to be a token,
    lexicon weight, booster weight, negation, in capitals, urgency words and
    symbols, upper-case letters beyond ASCII, movement words, places in
    ``names`` found in it, places of longer names that may begin in it)."""
    one = [(at, n, lower) for at, (n, lower) in enumerate(names) if len(n.split(" ")) == 1]
    more = [(at, n.split(" ")[0], lower) for at, (n, lower) in enumerate(names) if len(n.split(" ")) > 1]
    either = lambda terms: "|".join(re.escape(x) for x in sorted(terms)) or "\n"
    acts = {*tx.URGENCY_WORDS, *K.MOVEMENT_WORDS}
    # Names in the case they are looked for in: "GE" is in few words, "ge" in many.
    exact, lowered = (either({n for _, n, lower in one + more if lower == x}) for x in (False, True))
    acting, naming, naming_low = (re.compile(x) for x in (either(acts), exact, lowered))

    def look(w: str):
        low, c = w.lower(), core(w)
        key, short, odd = c.lower(), len(c) <= 1, not w.isascii()
        v, b, neg = (None, 0.0, False) if short else (weight.get(key), boost.get(key, 0.0), key in negations)
        urgent, upper, moves, found, begun = 0, 0, (), (), ()
        if acting.search(low):
            urgent, moves = len(tx.whole_words(w, tx.URGENCY_WORDS)), tuple(tx.whole_words(w, K.MOVEMENT_WORDS))
        if naming.search(w) or naming_low.search(low):
            found = tuple(at for at, n, lower in one if n in (low if lower else w))
            begun = tuple(at for at, n, lower in more if (low if lower else w).endswith(n))
        if odd:
            urgent += len(tx.SYMBOL_RUN.findall(w))
            upper = sum(not x.isascii() and unicodedata.category(x) == "Lu" for x in w)
        said = (short, v, b, neg, v is not None and loud(c), urgent, upper, moves, found, begun)
        return 0 if said == SILENT else ONLY_SHORT if said == ONLY_SHORT else said
    whole = either({*weight, *boost, *negations, *acts} - {""})
    return WordFacts(look, f"{SHORT}|{ODD}|{exact}|(?i:{lowered}|(?:^|[^a-z0-9_])(?:{whole})(?:$|[^a-z0-9_]))")


def text_facts(text, names: dict | None = None, lexicon=K.VALENCE_LEXICON, boosters=K.BOOSTERS, negations=K.NEGATIONS) -> Column:
    """struct(n tokens, hits, exclaims, urgent, upper, moves, and an array per
    entry of ``names``).  ``hits``: of every token whose lower case is in
    ``lexicon`` its weight, whether it is in capitals in a text that is not all
    capitals, the booster weights of the three tokens before it (else 0), and
    whether a negation is among these.  ``names``: title -> (list, lower); the
    array holds the places in the list of the names found as substrings of the
    text (of the lower-cased text, if lower)."""
    names = names or {}
    flat = [(n, lower) for listed, lower in names.values() for n in listed]
    ends, total = {}, 0
    for title, (listed, _) in names.items():
        ends[title] = (total, total := total + len(listed))
    listed_in = [(title, a) for title, (a, z) in ends.items() for _ in range(a, z)]
    # Names that aren't words with single spaces between, and letters whose lower case may depend on
    # their place, are looked for in the whole text.
    plain = [n.isascii() and n.encode().split() == n.encode().split(b" ") and n != "" for n, _ in flat]
    always = [at for at, ok in enumerate(plain) if not ok]
    memo = _look([x if ok else ("\n", False) for x, ok in zip(flat, plain)], {k: float(w) for k, w in dict(lexicon).items()},
                 dict(boosters), frozenset(negations))

    def facts(raw: bytes, n: int, marks: list) -> dict:
        urgent, upper = 0, len(raw.translate(None, tx.NOT_UPPER))
        moves, hits, at, begun, mixed = [], [], set(), set(always), None
        said = None
        for i, f in marks:
            if f is ONLY_SHORT:
                n -= 1
                continue
            short, v, _, _, caps, u, up, mv, found, begins = f
            n -= short
            urgent += u
            upper += up
            moves += mv
            at.update(found)
            begun.update(begins)
            if v is None:
                continue
            if caps and mixed is None:
                mixed = some_small(raw)
            said = dict(marks) if said is None else said
            before, k = [], i
            while k and len(before) < 3:
                k -= 1
                if not (f := said.get(k, SILENT))[0]:
                    before.append(f)
            b = [x[2] for x in before] + [0.0] * 3
            hits.append({"v": v, "caps": caps and mixed, "b1": b[0], "b2": b[1], "b3": b[2], "negated": any(x[3] for x in before)})
        if begun:
            t = raw.decode()
            low = t.lower()
            at.update(k for k in begun if flat[k][0] in (low if flat[k][1] else t))
        out = {"n": n, "hits": hits, "exclaims": raw.count(b"!"), "urgent": urgent, "upper": upper, "moves": moves}
        for title in ends:
            out[title] = []
        for k in sorted(at):
            title, a = listed_in[k]
            out[title].append(k - a)
        return out

    counts = ("exclaims", "urgent", "upper")
    kind = f"struct<n:int,hits:{HIT},{','.join(f'{c}:int' for c in counts)},moves:array<string>{''.join(f',{x}:array<int>' for x in names)}>"
    arrow = pa.struct([("n", pa.int32()), ("hits", HIT_ARROW), *[(c, pa.int32()) for c in counts], ("moves", pa.list_(pa.string())),
                       *[(x, pa.list_(pa.int32())) for x in names]])

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(texts), ROWS):
            part = pc.fill_null(texts.slice(i, ROWS), "")
            raws = part.cast(pa.binary()).to_pylist()
            out += [facts(raw, n, marks) for raw, (n, marks) in zip(raws, memo.of(part))]
        return pa.array(out, arrow)
    return F.arrow_udf(run, kind)(F.col(text) if isinstance(text, str) else text)


def named(at: Column, names) -> Column:
    """The names at the places ``at`` of their list."""
    listed = F.array(*[F.lit(n) for n in names])
    return F.transform(at, lambda i: F.get(listed, i))
