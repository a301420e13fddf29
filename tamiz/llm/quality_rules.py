"""Quality rules: line-first cleaning.

Every line is judged by rules on symbols, capitals, repetition, punctuation, navigation and
boilerplate; lines that fail are removed, and a document is rejected if it loses too much of
its text that way or fails a base rule on the whole text.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from tamiz.llm.common import append_columns

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: Short menu labels and phrases of page furniture by language, lower case. Both are parameters of :class:`LineRules`: give others
#: for other languages.
MENU_WORDS = {
    "en": "home menu login logout register search next previous prev back top contact about help sitemap faq share print more skip cart",
    "es": "inicio menú buscar siguiente anterior volver arriba contacto acerca ayuda mapa compartir imprimir más carrito entrar salir registro",
    "fr": "accueil menu rechercher suivant précédent retour haut contact propos aide plan partager imprimer plus panier connexion inscription",
    "de": "startseite menü suche weiter zurück nach oben kontakt über hilfe übersicht teilen drucken mehr warenkorb anmelden abmelden "
          "registrieren impressum datenschutz",
}
PHRASES = {
    "en": ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
           "enable javascript", "javascript is disabled", "sign up for our newsletter", "subscribe to our newsletter",
           "click here to", "skip to content", "back to top", "powered by"),
    "es": ("todos los derechos reservados", "aviso legal", "términos de uso", "condiciones de uso", "política de privacidad",
           "política de cookies", "aceptar cookies", "active javascript", "suscríbete a", "haga clic aquí", "saltar al contenido"),
    "fr": ("tous droits réservés", "mentions légales", "conditions d'utilisation", "politique de confidentialité",
           "politique de cookies", "accepter les cookies", "activer javascript", "abonnez-vous", "cliquez ici", "aller au contenu"),
    "de": ("alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookie-richtlinie", "cookies akzeptieren",
           "javascript aktivieren", "newsletter abonnieren", "klicken sie hier", "zum inhalt springen", "nach oben scrollen"),
}
SEPARATOR = re.compile(r"\s[|»›•·>]\s|[|»›•]")


@dataclass(frozen=True)
class LineRules:
    """Limits; each can be set by the caller."""

    symbols_per_word: float = 0.2
    capital_share: float = 0.7
    capital_words: int = 4
    repeat_words: int = 8
    top_word_share: float = 0.5
    unpunctuated_words: int = 80
    menu_cells: int = 4
    boilerplate_words: int = 25
    lost_share: float = 0.5
    min_words: int = 20
    repeat_percent: int = 30
    menu_words: frozenset[str] = frozenset(w for words in MENU_WORDS.values() for w in words.split())
    phrases: tuple[str, ...] = tuple(p for some in PHRASES.values() for p in some)

    @functools.cached_property
    def furniture(self) -> re.Pattern:
        """Any of the phrases; nothing if there are none."""
        return re.compile("|".join(map(re.escape, self.phrases)) if self.phrases else r"(?!)")


RULES = LineRules()


def line_fault(line: str, words: list[str], rules: LineRules = RULES) -> str | None:
    """Name of the first rule that the line fails, or None. A line without a word passes."""
    n = len(words)
    if not n:
        return None
    cells = [c for c in SEPARATOR.split(line) if c.strip()]
    if len(cells) >= rules.menu_cells and max(len(c.split()) for c in cells) <= 3:
        return "navigation"
    if n <= 12 and sum(w.strip(".,:;|»›•-").lower() in rules.menu_words for w in words) > 0.6 * n:
        return "navigation"
    symbols = sum(line.count(c) for c in SYMBOLS)
    if symbols >= 3 and symbols > rules.symbols_per_word * n:
        return "symbols"
    if n >= rules.capital_words and sum(map(str.isupper, words)) > rules.capital_share * n:
        return "capitals"
    if n >= rules.repeat_words and 2 * len(set(words)) < n:
        if Counter(words).most_common(1)[0][1] > rules.top_word_share * n:
            return "repetition"
    if n >= rules.unpunctuated_words and not any(c in line for c in ".,;:!?…。，！？؟،।"):
        return "punctuation"
    if n <= rules.boilerplate_words and rules.furniture.search(line.lower()):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the list.

    Windows are numbered exactly: pairs of words, pairs of pairs and so on get a number each.
    """
    n = len(words)
    if n <= width:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    step = 1
    while step < width:
        pair = codes[:-step] * (int(codes.max()) + 1) + codes[step:]
        _, codes, counts = np.unique(pair, return_inverse=True, return_counts=True)
        step *= 2
        if len(counts) == len(codes):
            return 0
    again = counts[codes] > 1
    starts = np.flatnonzero(again)
    opened = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return int((np.cumsum(opened)[:n] > 0).sum())


def judge(text: str | None, rules: LineRules = RULES) -> tuple:
    """Values of :data:`FIELDS` for one text; NULL counts as empty."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    word_chars = len(text) - sum(text.count(c) for c in WHITE)
    seen, kept, dup, removed, chars, lost = set(), [], 0, 0, 0, 0
    for line in text.split("\n"):
        parts = _split(line)
        if parts:
            if line in seen:
                dup += 1
            seen.add(line)
            chars += len(line)
            if line_fault(line, parts, rules):
                removed += 1
                lost += len(line)
                continue
        kept.append(line)
    repeats = repeated_words(words)
    failed = n_words < rules.min_words or 100 * repeats > rules.repeat_percent * n_words
    share = lost / chars if chars else 0.0
    return (n_words, word_chars, sum(text.count(c) for c in SYMBOLS), dup, repeats, failed,
            not failed and share <= rules.lost_share, removed, share, "\n".join(kept))


def _split(line: str) -> list[str]:
    """Words of a line; only the six ASCII white space characters part words."""
    return [w for w in re.split(r"[ \t-\r]+", line) if w] if not line.isascii() else _ascii_split(line)


def _ascii_split(line: str) -> list[str]:
    # str.split also parts at the four ASCII separator controls, which are no white space here.
    if any(c in line for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in re.split(r"[ \t-\r]+", line) if w]
    return line.split()


FIELDS = StructType([
    StructField("n_words", LongType()), StructField("word_chars", LongType()), StructField("n_symbols", LongType()),
    StructField("n_dup_lines", LongType()), StructField("n_repeat_words", LongType()),
    StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
    StructField("removed_lines", LongType()), StructField("lost_share", DoubleType()),
    StructField("clean_text", StringType()),
])


def quality_rules(docs: DataFrame, text: str = "text", rules: LineRules = RULES) -> DataFrame:
    """``docs`` with the columns of :data:`FIELDS`; one row for each row, in one pass, without a shuffle.

    A NULL text counts as empty and fails the base rule on words. Repeated rows are judged each
    for themselves, and so are texts that tie in every count. Long texts are judged whole; an empty table gives no rows. Columns named
    like a new one are replaced.
    """
    return append_columns(docs, text, FIELDS, lambda texts: list(zip(*(judge(t, rules) for t in texts))))


def clean(docs: DataFrame, text: str = "text", rules: LineRules = RULES) -> DataFrame:
    """The kept documents with their failing lines removed; columns as in ``docs``, ``n_chars`` kept true."""
    marked = quality_rules(docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("judged")),
                           "judged", rules).filter("kept")
    new = {text: F.col("clean_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return marked.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
