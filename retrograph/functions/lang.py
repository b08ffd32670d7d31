"""Word lists of the languages the engine knows; others have empty ones."""

from __future__ import annotations


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: Words of one letter that count as tokens (without accents).
ONE_LETTER = {"en": _words("a i"), "es": _words("a e o y"), "fr": _words("a y"), "gl": _words("a e o"), "pt": _words("a e o")}

#: Stopwords in spellings without accents, in order of the alphabet.
STOPWORDS = {
    "en": _words("a an and as at be but by for from he her his i in is it of on or she that the to was we with you"),
    "es": _words("a al con de del e el en la las lo los o por que se su sus un una y"),
    "fr": _words("au aux avec ce ces dans de des du elle en et il je la le les mais ne nous ou par pas pour que qui se sur un une vous y"),
    "gl": _words("a ao as co coa con da das de do dos e en na nas no nos o os ou por que se un unha"),
    "pt": _words("a ao as com da das de do dos e em o os ou por que se um uma"),
}

#: Words a phrase had better not end with.
WEAK_LAST = {
    "es": _words("a al con contra de del desde durante e el en entre hacia hasta la las le lo los me o para por que se sin sobre su te un una y"),
    "pt": _words("a ao as com da das de do dos e em na nas no nos o os ou para por que se um uma"),
}
#: Words a phrase had better not begin with.
WEAK_FIRST = {"es": _words("al con de del e en o para por y"), "pt": _words("ao com da de do e em ou para por")}
FUNCTION_WORDS = {lang: WEAK_LAST[lang] | WEAK_FIRST[lang] for lang in WEAK_LAST}

#: First letter of a tag to a coarse part of speech.
COARSE_POS = {"N": "NOUN", "A": "ADJ", "V": "VERB", "D": "DET", "P": "PRON", "S": "ADP", "C": "CONJ", "I": "INTJ", "F": "PUNCT", "Z": "NUM"}

#: Tag prefixes to Spanish labels; the first that fits counts.
POS_LABELS = [
    ("I", "interjección"),
    ("NC", "sustantivo"),
    ("NP", "sustantivo"),
    ("AQ", "adjetivo"),
    ("RG", "adverbio"),
    ("RN", "adverbio"),
    ("SP", "preposición"),
    ("CC", "conjunción"),
    ("CS", "conjunción"),
    ("D", "determinante"),
    ("P", "pronombre"),
    ("Z", "numeral"),
    ("VMN", "verbo"),
    ("VM", "forma"),
]


def _slots(text: str) -> dict[str, dict[str, int]]:
    """'N type gender' says that tags with N have their type at 1 and gender at 2."""
    rows = (line.split() for line in text.strip().splitlines())
    return {pos: {name: k + 1 for k, name in enumerate(names)} for pos, *names in rows}


#: For each language and first letter of a tag, where features stand in it.
FEATURE_SLOTS = {
    "es": _slots("""
        A type degree gender number possessor_pers possessor_num
        C type
        D type person gender number possessor_num
        I
        N type gender number neclass nesubclass degree
        P type person gender number case polite
        R type
        S type
        V type mood tense person number gender
        W
        Z type
    """),
    "gl": _slots("""
        A type degree gender number
        C type
        D type person gender number possessor_num
        I
        N type gender number neclass nesubclass degree
        P type person gender number case possessor_num polite
        R type
        S type contracted gender number
        V type mood tense person number gender
        W
        Z type
    """),
}
#: Parts of speech whose neighbours must agree, and values that agree with all others.
AGREEING = ("A", "D", "N")
WILDCARDS = {"es": {"gender": ("C",), "number": ("N",)}, "gl": {"gender": ("C", "N"), "number": ("N",)}}
