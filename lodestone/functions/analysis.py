"""Words of a text: folding, splitting and English stems."""

from __future__ import annotations

import re
import unicodedata
from functools import cache, lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}]+"


@cache
def _accents() -> tuple[str, str]:
    """Latin letters with marks and their bare letters, by decomposition."""
    marked, bare = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and all(unicodedata.combining(c) for c in parts[1:]):
            marked.append(chr(code))
            bare.append(parts[0])
    return "".join(marked), "".join(bare)


def fold(text: Column) -> Column:
    """Lower case without accents; ASCII text needs no look at single letters."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(F.lower(text), *_accents()))


def fold_text(text: str) -> str:
    """The same rule for a query on the driver."""
    return text.lower().translate(str.maketrans(*_accents()))


def words(text: Column) -> Column:
    """Folded runs of letters and digits, in order."""
    return F.regexp_extract_all(fold(text), F.lit(WORD), F.lit(0))


def query_phrases(query: str) -> list[list[str]]:
    """Searched phrases: each run of ASCII word characters is one.

    An underscore joins the words of a phrase, so ``foo_bar`` asks for ``foo``
    directly followed by ``bar``.
    """
    runs = re.findall(r"[A-Za-z0-9_]+", query or "")
    phrases = [[w for w in fold_text(run).split("_") if w] for run in runs]
    return [p for p in phrases if p]


# --- English stems ----------------------------------------------------------

# Fixed value: English stop words of full-text search.
STOP_WORDS = frozenset("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own same
so than too very s t can will just don should now
""".split())

# Suffix rules of the English stemmer, longest first.
STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
]
STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP4 = [
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous",
    "ive", "ize", "al", "er", "ic",
]
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
# What some rule of a step ends in, so that most words are passed over at once.
RULES4 = [(suffix, "") for suffix in STEP4]
ENDS2, ENDS3, ENDS4 = tuple(s for s, _ in STEP2), tuple(s for s, _ in STEP3), tuple(STEP4)
VOWELS = "aeiouy"
VOWEL = re.compile("[aeiouy]")
REGION = re.compile("[aeiouy][^aeiouy]")
DOUBLE = re.compile(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")
LI, ION = re.compile("[cdeghkmnrt]li$"), re.compile("[st]ion$")
FIRST_Y, LATER_Y = re.compile("^y"), re.compile(r"(?<=[aeiouy])y")
SHORT = re.compile(r"(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _regions(word: str) -> tuple[int, int]:
    """Where the two suffix regions start: after a vowel and a consonant, twice."""
    for prefix in ("gener", "commun", "arsen"):
        if word.startswith(prefix):
            r1 = len(prefix)
            break
    else:
        found = REGION.search(word)
        r1 = found.end() if found else len(word)
    found = REGION.search(word, r1)
    return r1, found.end() if found else len(word)


def _inflections(word: str, r1: int) -> str:
    """Plurals, then past and progressive forms."""
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and VOWEL.search(word[:-2]):
        word = word[:-1]
    if word in KEPT_AFTER_1A:
        return word
    for suffix in ("eedly", "eed"):
        if word.endswith(suffix):
            return word[: -len(suffix)] + "ee" if len(word) - len(suffix) >= r1 else word
    for suffix in ("ingly", "edly", "ing", "ed"):
        if word.endswith(suffix) and VOWEL.search(word[: -len(suffix)]):
            word = word[: -len(suffix)]
            if word.endswith(("at", "bl", "iz")):
                return word + "e"
            if DOUBLE.search(word):
                return word[:-1]
            return word + "e" if r1 >= len(word) and SHORT.search(word) else word
    return word


def _derivations(word: str, r1: int, r2: int) -> str:
    """Derived endings, longest suffix first; only inside the regions."""
    def replaced(rules, ends, region):
        for suffix, by in rules if word.endswith(ends) else ():
            if word.endswith(suffix):
                return word[: -len(suffix)] + by if len(word) - len(suffix) >= region else word
        return None

    done = replaced(STEP2, ENDS2, r1)
    if done is None and word.endswith("ogi") and len(word) - 3 >= r1 and word[-4:-3] == "l":
        done = word[:-1]
    if done is None and LI.search(word) and len(word) - 2 >= r1:
        done = word[:-2]
    word = word if done is None else done
    done = replaced(STEP3, ENDS3, r1)
    if done is None and word.endswith("ative") and len(word) - 5 >= r2:
        done = word[:-5]
    word = word if done is None else done
    done = replaced(RULES4, ENDS4, r2)
    if done is None and ION.search(word) and len(word) - 3 >= r2:
        done = word[:-3]
    word = word if done is None else done
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not SHORT.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """English stem by the published Porter2 rules."""
    if len(word) <= 2 or not word.isascii() or not word.isalpha():
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    if "y" in word:
        word = LATER_Y.sub("Y", FIRST_Y.sub("Y", word))
    r1, r2 = _regions(word)
    word = _inflections(word, r1)
    if word.lower() in KEPT_AFTER_1A:
        return word.lower()
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    return _derivations(word, r1, r2).lower()


def lexeme(word: str) -> str:
    """Stem of a word, empty for a stop word."""
    return "" if word in STOP_WORDS else stem(word)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _lexemes(tokens: pa.Array) -> pa.Array:
    # Each distinct word of a batch is stemmed once.
    coded = pc.dictionary_encode(tokens.flatten())
    stems = pa.array([lexeme(w) for w in coded.dictionary.to_pylist()], pa.string())
    return pa.ListArray.from_arrays(_offsets(tokens), stems.take(coded.indices), mask=tokens.is_null())


def _offsets(lists: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])


def lexemes(text: Column) -> Column:
    """Stems by position; a stop word leaves an empty place."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return _lexemes(tokens)
