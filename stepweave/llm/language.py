"""Which language a text is written in, from scripts and function words."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

# Frequent function words by language, in natural order.
FUNCTION_WORDS = {
    "en": "the a an and or but of to in on at is are was were be been it its that this these with for from as by not no so if then there which what how why when where should would could can will has have had do does did you your he she his her they them their we our i my me before after while between enough",
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber nicht kein keine ist sind war waren wird werden wurde sich es er sie wir ihr ich mich zu zum zur im in am an auf aus bei mit nach von vor über unter für durch gegen dass weil wenn sobald bevor deshalb dann danach zuerst muss müssen kann soll noch nur auch hier nichts",
    "fr": "le la les un une des du de d l et ou mais donc ne pas plus est sont était être a ont il elle ils elles on nous vous je tu se s ce cette ces qui que dans sur sous au aux en par pour avec sans avant après vers dès puis ensuite d'abord faut doit peut rien très bien son sa ses leur",
    "es": "el la los las un una unos unas y o pero no es son está están era ser se lo le les su sus que qui de del al en con sin por para antes después luego primero hacia sobre encima cuando porque eso esto hay debe puede nada muy más yo tú él ella ellos usted como donde",
    "it": "il lo la i gli le un uno una e o ma non è sono era essere si che chi di del della dei delle al allo alla ai nel nella con senza per da dal prima dopo poi verso sopra sotto quando quindi perché deve può bisogna niente nulla molto più io tu lui lei loro come dove",
    "pt": "o a os as um uma uns umas e ou mas não é são está estão era ser se lhe que quem de do da dos das ao à aos no na nos nas em com sem por para pelo pela antes depois primeiro preciso sobre cima quando porque isso isto há deve pode nada muito mais eu tu ele ela eles você como onde",
    "nl": "de het een en of maar niet geen is zijn was waren wordt worden zich er dat die dit deze van voor met op in uit aan bij naar over onder door als wanneer omdat dan eerst moet kan nog ook hier niets ik jij hij zij wij",
}
# Words of further languages that none of those above has.
OWN_WORDS = {
    "da": "og jeg ikke det som til af den har blev være hun hvor når skal fordi meget også ind ud",
    "sv": "och jag inte det som till av den har blev vara hon när ska därför mycket också måste kan är",
    "pl": "i w z na do się nie jest są był była że który która przez przed po aby musi może tylko bardzo jego jej ten tego oraz",
    "cs": "a v na se je jsou byl byla že který která před aby musí může jen velmi jeho jejich ten toho tak",
    "fi": "ja on ei se että kun mutta olla hän ovat oli joka sen niin tämä pitää ensin sitten",
    "tr": "ve bir bu için ile da de gibi çok daha sonra önce değil ama olan olarak kadar",
    "ro": "și este sunt pentru care din cu nu că mai dar după înainte trebuie poate foarte",
    "hu": "és az egy nem hogy van volt vagy csak még majd mert amikor után előtt kell",
}
# What requests and names of languages look like in prompts.
LANGUAGE_NAMES = {
    "en": "english englisch anglais inglés ingles inglese inglês",
    "de": "german deutsch allemand alemán aleman tedesco alemão",
    "fr": "french französisch français francais francés frances francese francês",
    "es": "spanish spanisch espagnol español espanol castellano spagnolo espanhol",
    "it": "italian italienisch italien italiano",
    "pt": "portuguese portugiesisch portugais portugués portoghese português portugues",
    "nl": "dutch niederländisch nederlands",
    "ru": "russian russisch russe ruso russo русском русски",
    "ja": "japanese japanisch japonais japonés giapponese japonês 日本語",
    "zh": "chinese mandarin chinesisch chinois chino cinese chinês 中文 汉语",
    "ko": "korean koreanisch coréen coreano 한국어",
    "ar": "arabic arabisch arabe árabe العربية",
    "pl": "polish polnisch polonais polaco polacco",
    "da": "danish dänisch danois danés danese",
    "sv": "swedish schwedisch suédois sueco svedese",
    "fi": "finnish finnisch",
    "cs": "czech tschechisch",
    "ro": "romanian rumänisch",
    "hu": "hungarian ungarisch",
    "tr": "turkish türkisch turc turco türkçe",
    "hi": "hindi",
}
_SCRIPTS = [
    ("ja", re.compile(r"[぀-ヿ]")), ("ko", re.compile(r"[가-힯]")), ("zh", re.compile(r"[一-鿿]")),
    ("ru", re.compile(r"[Ѐ-ӿ]")), ("ar", re.compile(r"[؀-ۿ]")), ("el", re.compile(r"[Ͱ-Ͽ]")),
    ("he", re.compile(r"[֐-׿]")), ("hi", re.compile(r"[ऀ-ॿ]")), ("th", re.compile(r"[฀-๿]")),
]
_WORD = re.compile(r"[^\W\d_]+")
_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_OWNERS: dict[str, list[str]] = {}
for _lang, _words in _SETS.items():
    for _w in _words:
        _OWNERS.setdefault(_w, []).append(_lang)
for _lang, _words in OWN_WORDS.items():
    for _w in sorted(set(_words.split()) - {w for k in _SETS for w in _SETS[k]}):
        _OWNERS.setdefault(_w, []).append(_lang)
_LETTERS = {"ß": "de", "ä": "de", "ö": "de", "ñ": "es", "¿": "es", "¡": "es", "ã": "pt", "õ": "pt", "œ": "fr", "ê": "fr", "ù": "fr", "ì": "it", "ò": "it"}
_NAMES = {n: k for k, v in LANGUAGE_NAMES.items() for n in v.split()}
_ASKED = re.compile(
    r"(?:answer|reply|respond|write|response|explain|output|antworte\w*|réponds|répondez|responde|rispondi|responda|ответь\w*|напиши\w*)\b[^.?!\n]{0,60}?"
    r"\b(?:in|auf|en|em|на|по)[ -]?(\w+)",
    re.I,
)


def scores(text: str) -> dict[str, float]:
    """Evidence for each language: function words, more for those of one language only, and letters."""
    out: dict[str, float] = {}
    low = text.lower()
    for w, n in Counter(_WORD.findall(low)).items():
        own = _OWNERS.get(w)
        if own:
            for k in own:
                out[k] = out.get(k, 0) + n * (1.5 if len(own) == 1 else 1 / len(own))
    for ch, k in () if text.isascii() else _LETTERS.items():
        if n := low.count(ch):
            out[k] = out.get(k, 0) + 0.7 * n
    return out


def language_of(text: str) -> str | None:
    """The language of a text; None where it shows too little of any."""
    for k, script in () if text.isascii() else _SCRIPTS:
        n = len(script.findall(text))
        letters = sum(map(str.isalpha, text)) if n else 0
        if n and (n * 3 >= letters or (k == "ja" and n >= 2 and n * 6 >= letters)):
            return k
    found = sorted(scores(text).items(), key=lambda x: -x[1])
    if not found or found[0][1] < 1.5 or (len(found) > 1 and found[0][1] < 1.15 * found[1][1]):
        return None
    return found[0][0]


@lru_cache(maxsize=20_000)
def wanted_language(prompt: str) -> str | None:
    """The language that an answer should be in: the one asked for, else the prompt's own."""
    return asked_language(prompt) or language_of(prompt)


def asked_language(prompt: str) -> str | None:
    """The language that a prompt asks the answer to be in, if it does; the last request counts."""
    got = [_NAMES[m.group(1).lower()] for m in _ASKED.finditer(prompt) if m.group(1).lower() in _NAMES]
    return got[-1] if got else next((k for n, k in _NAMES.items() if not n.isascii() and n + "で" in prompt), None)
