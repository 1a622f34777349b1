"""Line-first quality rules.

Every line is judged: does it end like a sentence, is it navigation (by separators, or
as part of a run of very short lines), is it boilerplate.  Lines that fail are removed, and a document that loses too much of its
text is rejected.  Whole-document figures (symbols, repeated lines and windows) come
from the same pass.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = re.compile(r"[#*$%&|<>]")
#: White space of lines and words, the same everywhere.
_S = r"[\x20\x09-\x0D]"
_CLOSE = r"""["'”’»)\]]*"""
#: What a sentence ends with, closing quotes and brackets aside.
SENTENCE_END = re.compile(rf"[.!?…:;。！？]{_CLOSE}{_S}*$")
#: A sentence that ends inside a line and is followed by a word: running text, even if cut off at the end.
SENTENCE_INSIDE = re.compile(rf"[.!?…]{_CLOSE}{_S}+[^\x20\x09-\x0D|»›>•]")
#: Fixed phrases of page furniture, in English, German, French and Spanish; single words
#: that running text has as well aren't among them.
PHRASES = (
    "(?:enable|requires?|turn on|disable) javascript|javascript (?:is|must be) (?:disabled|enabled|required|turned)",
    "(?:uses?|using|accept|reject|manage|store|set) (?:[a-z]+ )?cookies|cookies? (?:policy|settings|consent|notice|preferences|statement)|cookies (?:on|to) (?:this|our|give|improve|personali[sz]e)",
    "privacy policy|terms of (?:use|service)|all rights reserved|click here|lorem ipsum|log ?in to (?:your|continue|see|view|comment|the)|subscribe (?:to|now|for|today|and)",
    "datenschutzerklärung|nutzungsbedingungen|alle rechte vorbehalten|hier klicken|klicken sie hier|newsletter abonnieren|verwende[nt]+ (?:[a-zäöü]+ )?cookies|cookies (?:akzeptieren|ablehnen)",
    "politique de confidentialité|conditions d.utilisation|tous droits réservés|cliquez ici|mentions légales|abonnez-vous (?:à|a|au|pour)|utilis(?:e|ons) des cookies|accepter les cookies",
    "política de privacidad|términos de uso|términos y condiciones|todos los derechos reservados|haga clic aquí|aviso legal|suscríb(?:ete|ase) (?:a|al|para|ya)|utiliza(?:mos)? cookies|aceptar (?:las )?cookies",
)
BOILERPLATE = re.compile("|".join(PHRASES), re.I)
NAVIGATION = re.compile(rf"{_S}[|»›>•]{_S}")
#: A line with more symbols than this share of its words fails; so does one with so many separators.
MOST_SYMBOLS, MOST_SEPARATORS = 0.3, 2
#: A menu is a run of so many lines, blank ones aside, of so few words each, none of which
#: ends like a sentence or in a comma.
MENU_LINES, MENU_WORDS = 5, 3
MENU_END = re.compile(rf"[.!?…:;,。！？]{_CLOSE}{_S}*$")
#: A document must keep this share of its word characters.
LEAST_KEPT = 0.5
WINDOW = 8


def line_kept(line: str) -> bool:
    """Whether a line passes the rules; a line without words does, as nothing is lost."""
    words = line.encode().split()
    if not words:
        return True
    if len(NAVIGATION.findall(line)) >= MOST_SEPARATORS:
        return False
    if len(words) <= 30 and BOILERPLATE.search(line):
        return False
    if len(SYMBOLS.findall(line)) > MOST_SYMBOLS * len(words):
        return False
    if len(words) >= 4 and line.count("!!") > MOST_SYMBOLS * len(words):
        return False
    return len(words) <= 12 or bool(SENTENCE_END.search(line) or SENTENCE_INSIDE.search(line))


def in_menus(lines: list[str]) -> set[int]:
    """The places of lines that stand in a menu."""
    found, held = set(), []
    for k, line in enumerate([*lines, "."]):
        words = len(line.encode().split())
        if words and (words > MENU_WORDS or MENU_END.search(line)):
            if len(held) >= MENU_LINES:
                found.update(held)
            held = []
        elif words:
            held.append(k)
    return found


def lines_kept(text: str) -> list[tuple[str, bool]]:
    """Each line and whether it passes, by itself and among its neighbours."""
    lines = text.split("\n")
    menu = in_menus(lines)
    return [(x, k not in menu and line_kept(x)) for k, x in enumerate(lines)]


def cleaned(text: str) -> str:
    return "\n".join(x for x, good in lines_kept(text) if good)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of WINDOW words that the text holds twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    k = np.array([ids.setdefault(w, len(ids)) for w in words], np.uint64)
    if len(ids) == len(words):
        return 0
    # Exact: ranks of windows of 2, 4, then 8 words.
    for step in (1, 2, 4):
        pair = k[:-step] * np.uint64(len(words) + 1) + k[step:]
        k = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
    twice = np.bincount(k.astype(np.int64))[k.astype(np.int64)] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, kept_chars long, cleaned string"


def figures(text: str | None, clean: bool) -> tuple:
    text = text or ""
    raw = text.encode()
    words = raw.split()
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode())
    seen, again, left, stay = set(), 0, 0, []
    for line, good in lines_kept(text):
        if good:
            left += len(b"".join(line.encode().split()).decode())
            stay.append(line)
        if line in seen:
            again += 1
        elif line.encode().split():
            seen.add(line)
    return len(words), chars, len(SYMBOLS.findall(text)), again, repeated_words(words), left, "\n".join(stay) if clean else None


def judge(docs: DataFrame, text_col: str = "text", clean: bool = True) -> DataFrame:
    """(doc, rules): ``doc`` holds the row; ``rules`` the figures, base_failed, kept and,
    if ``clean``, the text of the lines that passed.

    A null or empty text has no words and fails.  Each row is judged by itself.
    """

    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pd.DataFrame([figures(t, clean) for t in texts], columns=names)

    r = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), run.asNondeterministic()(F.col(text_col).cast("string")).alias("r"))
    failed = (F.col("r.n_words") < 20) | (100 * F.col("r.n_repeat_words") > 30 * F.col("r.n_words"))
    kept = ~failed & (F.col("r.kept_chars") >= LEAST_KEPT * F.col("r.word_chars"))
    return r.select("doc", F.struct("r.*", failed.alias("base_failed"), kept.alias("kept")).alias("rules"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for each row."""
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(some, clean=False).select("doc.doc_id", *[F.col(f"rules.{n}").alias(n) for n in names])


def keep_clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with the lines that passed."""
    kept = judge(docs, text_col).where("rules.kept")
    return kept.select(*[(F.col("rules.cleaned") if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns])
