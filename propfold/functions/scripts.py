"""Letters of other scripts in ASCII: fixed tables for alphabets, rules for the rest.

Alphabets are given by their lower-case letters; capitals follow by rule, as do accented
letters, which are written as the letter they decompose into. Kana are consonant and vowel,
Hangul syllables are put together from their code point, decimal digits of any script have
their value, and compatibility forms (full width, ligatures, fractions, circled numbers)
are written as what they stand for. Han characters are left as they are.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

# Lower-case letters in the order of their code points, each with its ASCII.
ALPHABETS = [
    # Greek
    "α a β b γ g δ d ε e ζ z η e θ th ι i κ k λ l μ m ν n ξ x ο o π p ρ r ς s σ s τ t υ u φ ph χ kh ψ ps ω o",
    # Cyrillic
    "а a б b в v г g д d е e ж zh з z и i й i к k л l м m н n о o п p р r с s т t у u ф f х kh ц ts ч ch "
    "ш sh щ shch ъ ' ы y ь ' э e ю iu я ia ё io ђ dj ѓ gj є ie ѕ dz і i ї yi ј j љ lj њ nj ћ tsh ќ kj "
    "ў u џ dzh ґ g'",
    # Armenian
    "ա a բ b գ g դ d ե e զ z է e ը e թ t' ժ zh ի i լ l խ kh ծ ts կ k հ h ձ dz ղ gh ճ ch մ m յ y ն n շ sh "
    "ո o չ ch' պ p ջ j ռ rh ս s վ v տ t ր r ց ts' ւ w փ p' ք k' օ o ֆ f և ew",
    # Hebrew
    "א a ב b ג g ד d ה h ו v ז z ח kh ט t י y ך k כ k ל l ם m מ m ן n נ n ס s ע ` ף p פ p ץ ts צ ts ק q "
    "ר r ש sh ת t",
    # Arabic
    "ا a ب b ة @ ت t ث th ج j ح H خ kh د d ذ dh ر r ز z س s ش sh ص S ض D ط T ظ Z ع ` غ G ف f ق q ك k ل l "
    "م m ن n ه h و w ي y",
    # Georgian
    "ა a ბ b გ g დ d ე e ვ v ზ z თ t' ი i კ k ლ l მ m ნ n ო o პ p ჟ zh რ r ს s ტ t უ u ფ p' ქ k' ღ g' ყ q "
    "შ sh ჩ ch' ც ts' ძ dz წ ts ჭ ch ხ kh ჯ j ჰ h",
]

# The parts of a Hangul syllable, by their numbers.
HANGUL = (
    "g gg n d dd r m b bb s ss . j jj c k t p h".split(),
    "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(),
    ". g gg gs n nj nh d r rg rm rb rs rt rp rh m b bs s ss ng j c k t p h".split(),
)
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3

# Rows of kana in the order of their code points; a row has a letter for each
# vowel, those in "small" twice (a small and a full one), voiced rows follow their letter.
KANA_ROWS = [("", "small"), ("kg",), ("sz",), ("td", "tu"), ("n",), ("hbp",), ("m",)]
VOWELS = "aiueo"

FORMS = [(0x2070, 0x2190), (0x2460, 0x2500), (0xFB00, 0xFB07), (0xFF01, 0xFF5F), (0xBC, 0xBF)]


def kana() -> dict[str, str]:
    """Hiragana and katakana: both have the same order, 96 code points apart."""
    names: list[str] = []
    for consonants, *more in KANA_ROWS:
        for vowel in VOWELS:
            letters = [c + vowel for c in consonants] or [vowel]
            twice = "small" in more or f"{consonants[:1]}{vowel}" in more
            names += [letters[0]] * twice + letters
    names += ["ya", "ya", "yu", "yu", "yo", "yo", "ra", "ri", "ru", "re", "ro", "wa", "wa", "wi", "we", "wo", "n", "vu"]
    return {chr(start + k): name for start in (0x3041, 0x30A1) for k, name in enumerate(names)}


@cache
def letters() -> dict[str, str]:
    """Characters with their ASCII, of all scripts but Latin and Hangul."""
    found = kana()
    for alphabet in ALPHABETS:
        words = alphabet.split()
        for letter, ascii_ in zip(words[::2], words[1::2], strict=True):
            found[letter] = ascii_
            capital = letter.upper()
            if len(capital) == 1 and capital != letter:
                found.setdefault(capital, ascii_[0].upper() + ascii_[1:])
    for code in range(0x370, 0x2000):  # accented letters of these scripts
        letter = chr(code)
        base, *marks = unicodedata.normalize("NFD", letter)
        if letter not in found and marks and base in found and all(map(unicodedata.combining, marks)):
            found[letter] = found[base]
    for first, end in FORMS:
        for letter in map(chr, range(first, end)):
            plain = unicodedata.normalize("NFKD", letter).replace("⁄", "/")
            if plain != letter and plain.isascii() and plain.isprintable() and " " not in plain:
                found.setdefault(letter, plain)
    for code in range(0x100, sys.maxunicode + 1):
        if unicodedata.category(letter := chr(code)) == "Nd":
            found.setdefault(letter, str(unicodedata.decimal(letter)))
    return found


def hangul(letter: str) -> str:
    """ASCII of a Hangul syllable."""
    place = ord(letter) - HANGUL_FIRST
    parts = (place // 588, place % 588 // 28, place % 28)
    return "".join(names[k].replace(".", "") for names, k in zip(HANGUL, parts, strict=True))
