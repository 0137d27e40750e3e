"""Tokenising and word filters as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public English stop-word list of the NLTK corpus.
STOP_WORDS: list[str] = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Treebank-style splitting rules, applied in this order. They use
# neither look-around nor \b, so Java regex and RE2 give the same result.
TOKEN_RULES: list[tuple[str, str]] = [
    (r'([;@#$%&?!"()\[\]{}<>]|--+|\.\.\.)', " $1 "),
    (r"([:,])([^0-9])", " $1 $2"),
    (r"([^.])\.([ \t\n\x0B\f\r])", "$1 . $2"),
    (r"([^' ])('(?:s|m|d|ll|re|ve)?|n't) ", "$1 $2 "),
]
# Fused words and their parts. Replaced twice, because neighbouring
# matches share a space.
FUSED_WORDS: list[tuple[str, str]] = [
    (" cannot ", " can not "),
    (" gimme ", " gim me "),
    (" gonna ", " gon na "),
    (" gotta ", " got ta "),
    (" lemme ", " lem me "),
    (" wanna ", " wan na "),
    (" 'tis ", " 't is "),
    (" 'twas ", " 't was "),
]
ANY_FUSED = " (?:cannot|gimme|gonna|gotta|lemme|wanna|'tis|'twas) "
SPACE = r"[ \t\n\x0B\f\r]+"
HAS_ALNUM = "[A-Za-z0-9]"


def tokens(text: Column) -> Column:
    """Lower-case ``text`` and split it into word and punctuation tokens."""
    spaced = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    for pattern, repl in TOKEN_RULES:
        spaced = F.regexp_replace(spaced, pattern, repl)
    # a one-element transform names the spaced text, so that it is computed once
    parted = F.get(F.transform(F.array(spaced), _part_fused), F.lit(0))
    return F.filter(F.split(parted, SPACE), lambda t: t != "")


def _part_fused(text: Column) -> Column:
    out = text
    for fused, parts in FUSED_WORDS * 2:
        out = F.replace(out, F.lit(fused), F.lit(parts))
    return F.when(text.rlike(ANY_FUSED), out).otherwise(text)


def is_alnum(token: Column) -> Column:
    """At least one ASCII letter or digit."""
    return token.rlike(HAS_ALNUM)


def is_stop_word(token: Column) -> Column:
    return token.isin(STOP_WORDS)


def keep_word(token: Column) -> Column:
    return is_alnum(token) & ~is_stop_word(token)
