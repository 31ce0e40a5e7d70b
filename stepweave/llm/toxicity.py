"""Abusive, hateful and sexual language in documents.

Gradient-boosted trees over dense features of a sentence: lexicon densities,
second-person and other proximities, capitals, punctuation and obfuscation,
calibrated by isotonic regression; a document's score is that of its worst
sentence. Every sentence is measured, each wording once per batch of documents.

The model is fitted once and kept beside this module with the version of what
it was made from: ``python -m stepweave.llm.toxicity`` fits it anew.
"""

from __future__ import annotations

import json
import os
import random
import re
import unicodedata
from collections.abc import Sequence
from functools import cache, lru_cache

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepweave.llm import boosting, lexicons, phrasings

KINDS = ("abusive", "hateful", "sexual")
#: The classifier learns from at most this many sentences made from the seeds.
TRAINING_ROWS = 30_000
#: From this score on a document counts as of a kind: somewhat below one half, as what is missed costs more than a second look.
THRESHOLD = 0.4
MODEL_FILE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "toxicity_model.json")
#: Sentences whose results a task keeps; beyond it forgets them all, which costs time only.
MEMO_SENTENCES = 200_000
#: Characters of text that are measured at once.
BATCH_CHARS = 4_000_000
_MASK, _HIDDEN = "#*", "\x02"
_LEET = str.maketrans({"@": "a", "$": "s", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "€": "e", "|": "l", "!": "i"})
_TOKEN = re.compile(r"[a-z0-9@$#*€|!']*[a-z][a-z0-9@$#*€|!']*|#[@$#*a-z]+|[0-9]+")
_DOTTED = re.compile(r"(?<![a-z0-9])[a-z@$#*](?:[._\-][a-z@$#*]){2,}[a-z]{0,3}(?![a-z0-9])")
_SPACED = re.compile(r"(?<![a-z0-9])[a-z@$#*](?: [a-z@$#*]){2,}[a-z]{0,3}(?![a-z0-9])")
_END = re.compile(r"(?<=[.!?])[)\"'”’]*[^\S\n]+(?=\S)|\n")
_TRIPLE, _LONG = re.compile(r"(.)\1{2,}"), re.compile(r"(.)\1+")


@cache
def _plain() -> dict[int, str | None]:
    """Translation of accented and look-alike letters to plain ones; invisible characters vanish."""
    table: dict[int, str | None] = {}
    for c in [*range(0xA1, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        base = "".join(ch for ch in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(ch))
        if base != chr(c) and base.isascii():
            table[c] = base
    for a, b in lexicons.LOOKALIKES.items():
        table[ord(a)] = b
        if a.upper() != a:
            table[ord(a.upper())] = b.upper()
    table |= {ord("ß"): "ss", ord("’"): "'", ord("ø"): "o", ord("æ"): "ae", ord("œ"): "oe", ord("ı"): "i", 0xA0: " "}
    for c in [*range(0x200B, 0x2010), 0x2060, 0xFEFF, 0xAD, *range(0x300, 0x370)]:
        table[c] = None
    return table


def folded(text: str) -> tuple[str, str]:
    """The text in plain letters, and the same in lower case; both of one length."""
    if not text.isascii():
        text = text.translate(_plain())
    low = text.lower()
    return (text, low) if len(text) == len(low) else (low, low)


@cache
def _lexicon() -> tuple[dict[str, tuple[str, ...]], dict[str, tuple[str, ...]]]:
    """(whole words, beginnings), each with its categories."""
    whole: dict[str, list[str]] = {}
    stems: dict[str, list[str]] = {}
    for cat, words in lexicons.WORDS.items():
        for w in words.split():
            (stems if w.endswith("*") else whole).setdefault(w.rstrip("*"), []).append(cat)
    return {k: tuple(v) for k, v in whole.items()}, {k: tuple(v) for k, v in stems.items()}


@lru_cache(maxsize=200_000)
def categories(word: str) -> tuple[str, ...]:
    whole, stems = _lexicon()
    out = list(whole.get(word, ()))
    if word.endswith("s") and len(word) > 3:
        out += whole.get(word[:-1], ())
    for k in range(3, len(word) + 1):
        out += stems.get(word[:k], ())
    return tuple(dict.fromkeys(out))


_HARD = frozenset(("insult", "profanity", "dehuman", "sexual", "scorn"))


@cache
def _by_length() -> dict[int, list[str]]:
    """Words that a masked word may stand for."""
    out: dict[int, list[str]] = {}
    for cat in ("insult", "scorn", "profanity", "dehuman", "sexual"):
        for w in lexicons.WORDS[cat].split():
            base = w.rstrip("*")
            for form in {base, base + "s", base + "y", base + "e", base + "es", base + "er", base + "ing", base + "ed", base + "id"} if w.endswith("*") else {base, base + "s"}:
                out.setdefault(len(form), []).append(form)
    for phrase in ("hardcore sex",):
        out.setdefault(len(phrase), []).append(phrase)
    return out


@lru_cache(maxsize=200_000)
def decoded(token: str) -> tuple[str, bool]:
    """(plain word, whether it was disguised)."""
    core = token.strip("!'|")
    if core.isalpha():
        if not _TRIPLE.search(core) or core in _lexicon()[0]:
            return core, False
        for form in (_TRIPLE.sub(r"\1\1", core), _TRIPLE.sub(r"\1", core), _LONG.sub(r"\1", core)):
            if _HARD & set(categories(form)):
                return form, True
        return _TRIPLE.sub(r"\1", core), False
    leet = core.translate(_LEET)
    if leet.isalpha() and leet != core and any(ch.isalpha() for ch in core):
        return leet, bool(_HARD & set(categories(leet)))
    if any(ch in _MASK for ch in core):
        known = [(i, ch) for i, ch in enumerate(leet) if ch not in _MASK]
        if len(known) >= 2:
            for w in _by_length().get(len(leet), ()):
                if all(w[i] == ch for i, ch in known):
                    return w, True
            loose = re.compile("".join("[a-z]{1,2}" if ch in _MASK else re.escape(ch) for ch in leet))
            for k in range(len(leet) + 1, len(leet) + 4):
                for w in _by_length().get(k, ()):
                    if loose.fullmatch(w):
                        return w, True
    return core, False


def _join_dotted(m: re.Match) -> str:
    word = re.sub(r"[._\-]", "", m.group())
    return word + _HIDDEN if _HARD & set(categories(decoded(word)[0])) else word


def _fit(word: str) -> float:
    """How much of a word a listed one covers, less half of what it leaves; 0 for no listed word."""
    plain = decoded(word)[0]
    whole, stems = _lexicon()
    if plain in whole and _HARD & set(whole[plain]):
        return float(len(plain))
    best = max((k for k in range(3, len(plain) + 1) if _HARD & set(stems.get(plain[:k], ()))), default=0)
    return best - (len(plain) - best) / 2 if best else 0.0


def _join_spaced(m: re.Match) -> str:
    """Letters set apart, put together where that gives a listed word, with what stands around it."""
    parts = m.group().split(" ")
    tries = [(_fit("".join(parts[k:end])), k, end) for end in (len(parts), len(parts) - 1) for k in range(3)]
    best, k, end = max(tries, key=lambda t: t[0])
    return " ".join([*parts[:k], "".join(parts[k:end]) + _HIDDEN, *parts[end:]]) if best > 0 else m.group()


def words_of(low: str) -> tuple[list[str], int]:
    """Decoded words of a lower-case sentence and how many were disguised."""
    low = _SPACED.sub(_join_spaced, _DOTTED.sub(_join_dotted, low))
    disguised = low.count(_HIDDEN)
    out: list[str] = []
    for t in _TOKEN.findall(low):
        w, hid = decoded(t)
        disguised += hid
        out += w.split(" ") if " " in w else [w]
    return out, disguised


_NO_LETTER, _NO_CAPITAL = (bytes(c for c in range(128) if not keep(chr(c))) for keep in (str.isalpha, str.isupper))


def _letters(text: str) -> tuple[int, int]:
    """How many letters and how many capitals."""
    if text.isascii():
        b = text.encode()
        return len(b.translate(None, _NO_LETTER)), len(b.translate(None, _NO_CAPITAL))
    letters = [ch for ch in text if ch.isalpha()]
    return len(letters), sum(ch.isupper() for ch in letters)


# Forms of "to be" in the lexicons' languages.
_BE = frozenset("is are was were am be been being 're isn't aren't bist ist sind seid war waren es est sont etait suis eres son era eran sei sono e sao".split())
# Endings of names of peoples, and frequent words with such an ending.
_PEOPLE = re.compile(r"[a-z]{2,}(?:[^aeiou]i|an|ans|ians?|ish|ese|ites?|ari|ani|oni)")
_NO_PEOPLE = frozenset(
    "than then woman human urban organ ocean began clan plan scan span than title median guardian veteran artisan orphan slogan german pan tan van titan pagan divan sultan turban "
    "finish publish british polish dish wish fish establish abolish furnish punish english rubbish foolish selfish parish radish perish vanish these cheese obese those "
    "white site write quite opposite despite favorite granite definite infinite polite satellite suite unite website invite ignite excite elite sites writes unites "
    "alibi safari taxi khaki deli semi anti multi mini bikini graffiti roman christian librarian historian historians american european republican italian musician magician "
    "politician technician physician comedian civilian vegetarian victorian indian plans humans organs woman's fans cans loan loans lean mean clean bean swan jean dean vegan began".split()
)
_CATS = [*lexicons.WORDS, "be", "people", "number", "year"]
_BIT = {c: 1 << i for i, c in enumerate(_CATS)}
_IDIOMS = list(lexicons.IDIOMS)


def _any(*cats: str) -> int:
    return sum({_BIT[c] for c in cats})


_INSULT = _any("insult", "scorn", "stupid", "creature", "filthy", "profanity")
_HARM = _any("violence", "harm", "weapon")
_LOW = _any("dehuman", "creature", "filthy", "disease", "thief")
_SEX = _any("sexual", "sexbody", "sexact")
# Which kind of word follows which, and within how many words: proximities of the second person, of authors, peoples and bodies.
_NEAR, _WIDE = 3, 8
_FOLLOWS = [
    (_any("you"), _INSULT, _NEAR), (_INSULT, _any("you"), _NEAR), (_INSULT, _INSULT, _NEAR), (_any("author"), _INSULT, _WIDE), (_INSULT, _any("author"), _NEAR), (_any("work"), _INSULT, _WIDE),
    (_INSULT, _any("work"), _NEAR), (_any("be"), _INSULT, _NEAR), (_any("you"), _any("brain"), _WIDE), (_INSULT, _any("brain"), _NEAR), (_any("negation"), _any("you"), _WIDE), (_any("you"), _any("negation"), _NEAR),
    (_any("me"), _any("modal"), _NEAR), (_any("me"), _HARM, _WIDE), (_any("modal"), _HARM, _NEAR), (_HARM, _any("you"), _NEAR), (_any("you"), _HARM, _WIDE), (_HARM, _any("author"), _WIDE), (_any("author"), _HARM, _WIDE),
    (_any("modal"), _any("weapon"), _WIDE), (_HARM, _any("body_part"), _WIDE), (_any("wish"), _HARM | _any("death"), _WIDE), (_any("wish"), _any("you"), _NEAR), (_any("you"), _any("death"), _WIDE), (_any("death"), _any("you"), _WIDE),
    (_any("you"), _any("modal"), _NEAR), (_any("imperative"), _any("you"), _NEAR), (_any("imperative"), _HARM | _any("death"), _NEAR), (_any("author"), _any("modal"), _NEAR), (_any("you"), _any("work"), _WIDE),
    (_any("people"), _LOW, _WIDE), (_LOW, _any("people"), _NEAR), (_any("people"), _INSULT, _WIDE), (_INSULT, _any("people"), _NEAR), (_any("universal"), _any("people"), _NEAR), (_any("people"), _any("modal"), _NEAR),
    (_any("people"), _any("expel"), _WIDE), (_any("expel"), _any("people"), _WIDE), (_HARM, _any("people"), _WIDE), (_any("people"), _HARM, _WIDE), (_any("people"), _any("confine"), _WIDE), (_any("confine"), _any("people"), _WIDE),
    (_any("negation"), _any("people"), _WIDE), (_any("people"), _any("negation"), _NEAR), (_any("people"), _any("society"), _WIDE), (_any("society"), _any("people"), _WIDE), (_any("people"), _any("rights"), _WIDE),
    (_any("wish"), _any("people"), _NEAR), (_any("imperative"), _any("people"), _NEAR), (_any("group", "they"), _LOW, _WIDE), (_any("death"), _any("people"), _NEAR), (_any("people"), _any("past"), _NEAR), (_any("past"), _any("people"), _WIDE),
    (_any("past"), _HARM, _NEAR), (_any("modal"), _any("confine", "expel"), _WIDE), (_any("people"), _any("be"), _NEAR), (_any("society"), _LOW, _WIDE),
    (_SEX, _any("offer", "solicit"), _WIDE), (_any("offer", "solicit"), _SEX, _WIDE), (_any("lust"), _any("offer"), _NEAR), (_any("offer"), _any("lust"), _WIDE), (_any("sexact"), _any("sexbody", "intimate"), _WIDE),
    (_any("sexbody", "intimate"), _any("sexact"), _WIDE), (_any("they"), _any("sexact"), _NEAR), (_any("sexact"), _any("they"), _NEAR), (_any("me"), _any("sexact"), _WIDE), (_any("sexact"), _any("you"), _NEAR), (_any("you"), _any("sexbody"), _NEAR),
    (_any("wish"), _SEX, _WIDE), (_any("lust"), _SEX, _NEAR), (_SEX, _SEX, _NEAR), (_any("report"), _SEX, _WIDE), (_SEX, _any("report"), _WIDE), (_any("report"), _HARM, _WIDE), (_any("past"), _SEX, _NEAR), (_any("imperative"), _SEX | _any("lust"), _NEAR),
]
_FIRST = ["imperative", "you", "people", "universal", "negation", "me", "they", "insult", "lust", "author"]
FEATURES = [
    *_CATS, *_IDIOMS, *(f"follows_{i}" for i in range(len(_FOLLOWS))), *(f"first_{c}" for c in _FIRST),
    "insult_share", "harm_share", "low_share", "sex_share", "report_share", "caps", "marks", "disguised", "length", "all_caps",
]


@cache
def _idioms() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, cat in enumerate(_IDIOMS):
        for line in lexicons.IDIOMS[cat].strip().split("\n"):
            for idiom in line.strip().split("|"):
                found.add_word(f" {idiom} ", (i, len(idiom)))
    found.make_automaton()
    return found


@lru_cache(maxsize=400_000)
def _word_bits(word: str) -> int:
    bits = sum({_BIT[c] for c in categories(word)})
    if word in _BE:
        bits |= _BIT["be"]
    if word.isdigit():
        bits |= _BIT["number"] | (_BIT["year"] if len(word) == 4 and word[0] in "12" else 0)
    elif len(word) > 4 and word not in _NO_PEOPLE and not bits and _PEOPLE.fullmatch(word):
        bits |= _BIT["people"]
    return bits


def measured(sentences: list[tuple[str, str]]) -> np.ndarray:
    """The dense features, see :data:`FEATURES`, of sentences given as (plain text, the same in lower case)."""
    n = len(sentences)
    out = np.zeros((n, len(FEATURES)), np.float32)
    if not n:
        return out
    flat: list[int] = []
    size = np.zeros(n, np.int64)
    idioms, base = _idioms(), len(_CATS)
    tail = out[:, -5:]
    for i, (text, low) in enumerate(sentences):
        words, hidden = words_of(low)
        size[i] = len(words)
        flat += map(_word_bits, words)
        for _, (k, _) in idioms.iter(f" {' '.join(words)} "):
            out[i, base + k] += 1
        letters, capitals = _letters(text)
        caps = capitals / max(1, letters)
        tail[i] = caps, min(6, text.count("!") + text.count("?")), min(4, hidden), min(60, len(words)), caps > 0.9 and letters > 8
    bits = np.array(flat, np.uint64)
    sid = np.repeat(np.arange(n), size)
    count = lambda hit: np.bincount(sid[hit], minlength=n)
    has = lambda of, mask: (of & np.uint64(mask)) != 0
    for k in range(base):
        out[:, k] = np.minimum(5, count(has(bits, 1 << k)))
    # The kinds of word among the next few of the sentence.
    ahead, reach = {}, np.zeros(len(bits), np.uint64)
    for d in range(1, _WIDE + 1):
        if d < len(bits):
            same = sid[:-d] == sid[d:]
            reach[:-d] |= np.where(same, bits[d:], np.uint64(0))
        if d in (_NEAR, _WIDE):
            ahead[d] = reach.copy()
    at = base + len(_IDIOMS)
    np.minimum(out[:, base:at], 3, out=out[:, base:at])
    for k, (a, b, within) in enumerate(_FOLLOWS):
        out[:, at + k] = np.minimum(3, count(has(bits, a) & has(ahead[within], b)))
    at += len(_FOLLOWS)
    begin = np.cumsum(size) - size
    full = np.flatnonzero(size)
    first = bits[begin[full]] if len(full) else bits[:0]
    for k, c in enumerate(_FIRST):
        out[full, at + k] = has(first, _BIT[c])
    at += len(_FIRST)
    for k, mask in enumerate((_INSULT, _HARM, _LOW, _SEX, _BIT["report"])):
        out[:, at + k] = count(has(bits, mask)) / np.maximum(1, size)
    return out


def _disguise(word: str, rng: random.Random) -> str:
    kind = rng.randrange(6)
    if kind == 0:
        return " ".join(word)
    if kind == 1:
        return word.translate(str.maketrans({"a": "@", "s": "$", "e": "#", "i": "#", "o": "#", "u": "#"}))
    if kind == 2:
        return re.sub(r"([aeiou])", r"\1\1\1", word)
    if kind == 3 and len(word) > 4:
        return word[0] + "*" * (len(word) - 3) + word[-2:]
    if kind == 4:
        return word[: len(word) // 2] + "​" + word[len(word) // 2 :]
    return "".join(ch + rng.choice("._-") for ch in word).rstrip("._-")


def _people(rng: random.Random) -> str:
    """An invented people, by its ending or without one."""
    stem = "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randrange(1, 3))) + rng.choice(["l", "r", "n", "m", "st", "lv", "rr", "d", "k"])
    name = stem + rng.choice(["an", "ian", "ish", "ese", "ari", "ani", "i", "ite"])
    return name.capitalize() + ("s" if name[-1] in "ne" and rng.random() < 0.2 else "")


def _invented(rng: random.Random, endings: Sequence[str]) -> str:
    """An invented name: a few syllables and an ending."""
    name = "".join(rng.choice(("b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "s", "t", "v", "z", "qu", "w", "")) + rng.choice("aeiou") + rng.choice(("", "", "l", "n", "r")) for _ in range(rng.randrange(1, 4)))
    return (name + rng.choice(endings)).capitalize()


_OF_PLACES = ("ford", "wick", "mouth", "burg", "dale", "ton", "an", "i", "a", "ri", "fi", "li", "on", "o", "ese", "ish", "")
_OF_PERSONS = ("o", "a", "an", "el", "il", "ar", "i", "en", "us", "")


def seeds() -> list[tuple[int, str]]:
    """(class, sentence with slots) of all phrasings, class 0 none, 1 abusive, 2 hateful, 3 sexual."""
    return [
        (k, s.strip())
        for k, kind in enumerate(("none", *KINDS))
        for source in (lexicons.SEEDS, phrasings.SEEDS)
        for line in source[kind].strip().split("\n")
        for s in line.split("|")
    ]


def training_set(rows: int = TRAINING_ROWS, seed: int = 11) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Sentences made from the seeds, their class, and the number of the seed of each."""
    rng = random.Random(seed)
    known = seeds()
    fill = {k: v.split() for k, v in lexicons.SLOTS.items()} | phrasings.SLOTS | {"PLACE": lexicons.PLACES, "NAME": lexicons.NAMES}
    rng.shuffle(known)
    texts, labels = [], []
    for i in range(rows):
        kind, s = known[i % len(known)]
        hide = kind and rng.random() < 0.25
        people = _people(rng) if rng.random() < 0.7 else rng.choice(lexicons.GROUPS)

        def slot(m: re.Match) -> str:
            name = m.group(1)
            if name == "YEAR":
                return str(rng.randrange(1100, 2000))
            if name == "N":
                return str(rng.randrange(2, 90000))
            if name == "GROUP":
                return people
            if name in ("PLACE", "NAME") and rng.random() < 0.7:
                last = f" {_invented(rng, _OF_PERSONS)}" if name == "NAME" and rng.random() < 0.7 else ""
                return _invented(rng, _OF_PLACES if name == "PLACE" else _OF_PERSONS) + last
            w = rng.choice(fill[name])
            return _disguise(w, rng) if hide and " " not in w and name not in ("PLACE", "NAME") else w

        s = re.sub(r"\{([A-Z]+)\}", slot, s)
        style = rng.random()
        s = s.upper() if kind and style < 0.12 else s[:1].upper() + s[1:] if style < 0.7 else s
        s += rng.choice(["", ".", "!", "!!!", ".."]) if kind else rng.choice(["", ".", ".", "", "!"])
        if rng.random() < (0.15 if "[[" not in s and "{{" not in s else 0):
            s = rng.choice(["== {} ==", "<!-- {} -->", "* '''{}'''", "<ref>{}</ref>", "{{{{Notice|text={}}}}}"]).format(s)
        texts.append(s)
        labels.append(kind)
    return texts, np.array(labels), np.arange(rows) % len(known)


def fitted(rows: int = TRAINING_ROWS) -> list[boosting.Boosted]:
    """One calibrated classifier per kind, fitted anew."""
    texts, labels, seed = training_set(rows)
    x = measured([folded(t) for t in texts])
    # Calibrated on seeds that a fold's trees have not seen, not on other fillings of seen ones.
    return [boosting.fit(x, (labels == k + 1).astype(float), seed) for k in range(len(KINDS))]


@cache
def version() -> str:
    """What the model was made from: seeds, words and features, in one hash."""
    made_from = [_OF_PLACES, _OF_PERSONS, lexicons.WORDS, lexicons.IDIOMS, lexicons.SLOTS, phrasings.SLOTS, seeds(), FEATURES, _FOLLOWS, TRAINING_ROWS]
    return xxhash.xxh64_hexdigest(json.dumps(made_from, sort_keys=True))


@cache
def model() -> list[boosting.Boosted]:
    """One calibrated classifier per kind: the kept one if it is of this version, else fitted anew."""
    if os.path.isfile(MODEL_FILE):
        with open(MODEL_FILE, encoding="utf-8") as f:
            kept = json.load(f)
        if kept["version"] == version():
            return [boosting.Boosted.from_plain(m) for m in kept["models"]]
    return fitted()


def keep_model() -> None:
    """Fit the model and write it to :data:`MODEL_FILE`."""
    with open(MODEL_FILE, "w", encoding="utf-8") as f:
        json.dump({"version": version(), "models": [m.to_plain() for m in fitted()]}, f, separators=(",", ":"))


def sentences_of(text: str | None) -> list[str]:
    """The sentences of a text as they stand; a line's end ends one."""
    return [s for s in _END.split(text or "") if s]


def score_texts(texts: list[str | None], models: list[boosting.Boosted], memo: dict[str, np.ndarray | None] | None = None) -> np.ndarray:
    """Probability of each kind for each text: that of its worst sentence. ``memo`` keeps the sentences done."""
    memo = {} if memo is None else memo
    blank = np.array([m.probability(measured([("", "")]))[0] for m in models])
    out = np.tile(blank, (len(texts), 1))
    parts = [set(sentences_of(t)) for t in texts]
    new = [s for s in set().union(*parts) if s not in memo]
    if new:
        # Sentences with equal features, most of them without any word that counts, are judged once.
        x = measured([folded(s) for s in new])
        kinds: dict[bytes, int] = {}
        back = [kinds.setdefault(row.tobytes(), len(kinds)) for row in x]
        distinct = np.frombuffer(b"".join(kinds), x.dtype).reshape(len(kinds), -1)
        p = np.stack([m.probability(distinct) for m in models], axis=1)
        some = (p > blank).any(axis=1)
        memo |= {s: p[i] if some[i] else None for s, i in zip(new, back)}
    for i, own in enumerate(parts):
        for q in map(memo.__getitem__, own):
            if q is not None:
                np.maximum(out[i], q, out=out[i])
    if len(memo) > MEMO_SENTENCES:
        memo.clear()
    return out


def scored(docs: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """id_col, the columns of ``keep``, and a score between 0 and 1 for each kind: one row per row of ``docs``.

    Nulls: a NULL or empty text has the score of an empty sentence; rows
    without id are kept. Texts of any length are read whole, markup, comments
    and headings too. Repeated rows are scored alike; empty tables give none.
    Extra columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model())
    keep = keep or []

    def run(batches):
        memo: dict[str, np.ndarray | None] = {}
        for pdf in batches:
            # Parts of about BATCH_CHARS characters, long texts whole.
            part_of = (pdf[_TEXT].str.len().fillna(0).cumsum() // BATCH_CHARS).to_numpy()
            for _, part in pdf.groupby(part_of, sort=False):
                got = score_texts(part[_TEXT].tolist(), shared.value, memo)
                yield part.drop(columns=[_TEXT]).assign(**{k: got[:, j] for j, k in enumerate(KINDS)})

    _TEXT = "_text"
    base = docs.select(id_col, *keep, F.col(text_col).alias(_TEXT))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != _TEXT)
    return base.mapInPandas(run, f"{types}, " + ", ".join(f"{k} double" for k in KINDS))


def with_kind(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``kind``: the kind with the highest score of at least ``threshold``, else NULL."""
    best = F.greatest(*KINDS)
    kind = F.coalesce(*[F.when((F.col(k) == best) & (best >= threshold), F.lit(k)) for k in KINDS])
    return scores.withColumn("kind", kind)


if __name__ == "__main__":
    keep_model()
