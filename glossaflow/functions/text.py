"""Text functions as native column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# English non-breaking prefixes of the Europarl / Moses sentence splitter.
ENGLISH_PREFIXES = """
A B C D E F G H I J K L M N O P Q R S T U V W X Y Z
Adj Adm Adv Asst Bart Bldg Brig Bros Capt Cmdr Col Comdr Con Corp Cpl DR Dr Drs Ens Gen Gov Hon Hr Hosp
Insp Lt MM MR MRS MS Maj Messrs Mlle Mme Mr Mrs Ms Msgr Op Ord Pfc Ph Prof Pvt Rep Reps Res Rev Rt Sen
Sens Sfc Sgt Sr St Supt Surg v vs i.e rev e.g Nos Nr
""".split()

# Prefixes that do not break only when a number follows.
ENGLISH_NUMERIC_PREFIXES = "No Art pp".split()

_OPEN = r"['\"(\[¿¡\p{Pi}]"
_CLOSE = r"['\")\]\p{Pf}]"
_PREFIX_CHAR = r"[\p{L}\p{N}_.\-]"


@dataclass(frozen=True)
class SplitRules:
    """What the sentence splitter knows about a language."""

    prefixes: Sequence[str] = tuple(ENGLISH_PREFIXES)
    numeric_prefixes: Sequence[str] = tuple(ENGLISH_NUMERIC_PREFIXES)
    starters: str = r"\p{Lu}"


ENGLISH = SplitRules()


def _ends_with(words: Sequence[str]) -> str:
    """Look-behind for one of ``words`` standing on its own."""
    return rf"(?<!{_PREFIX_CHAR})(?:{'|'.join(re.escape(w) for w in words)})"


def mark_sentences(text: Column, rules: SplitRules = ENGLISH) -> Column:
    """Put each sentence of ``text`` on a line of its own.

    Runs of blanks are first reduced to one, so that a doubled blank can mark a gap that must not break
    (after an acronym such as ``U.S.``); the doubled blanks are reduced again at the end. All steps are
    regular expression replacements, which stay in generated code.
    """
    upper = f"[{rules.starters}]"
    start = f"[{rules.starters}0-9]"
    # look-behinds come after the period and the blank: they are then tried at sentence gaps only
    never = rf"(?<!{_ends_with(rules.prefixes)}\. )" if rules.prefixes else ""
    numeric = rf"(?<!{_ends_with(rules.numeric_prefixes)}\. (?=[0-9]))" if rules.numeric_prefixes else ""
    steps = [
        ("  +", " "),
        # ?, ! or several dots, then a sentence start
        (rf"([?!]|\.\.) (?={_OPEN}*{upper})", "$1\n"),
        # end mark inside a quotation or bracket
        (rf"([?!.] ?{_CLOSE}+) (?={_OPEN}* ?{upper})", "$1\n"),
        # end mark before an opening mark
        (rf"([?!.]) (?={_OPEN}+ ?{upper})", "$1\n"),
        # acronyms keep their gap
        (rf"(\.[{rules.starters}\-]+\.+) ", "$1  "),
        # the remaining periods
        (rf"\. (?={_OPEN}*{start}){never}{numeric}", ".\n"),
        ("  +", " "),
    ]
    for pattern, replacement in steps:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
    return text


def split_sentences(text: Column, rules: SplitRules = ENGLISH) -> Column:
    """Sentences of ``text`` in order; none for a blank text, null for null. Line ends are sentence ends."""
    marked = F.btrim(mark_sentences(text, rules), F.lit(" \t\r\n\f\u000b"))
    pieces = F.split(marked, "[ \r]*\n[ \r\n]*")
    return F.array_remove(pieces, F.lit(""))


def merge_sentences(sentences: Column) -> Column:
    """Sentences glued with single blanks."""
    return F.array_join(sentences, " ")


def strip_newlines(text: Column) -> Column:
    """Drop newlines; the words around one are glued."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def path_slug(name: Column) -> Column:
    """Model name as one path step."""
    return F.replace(name, F.lit("/"), F.lit("-"))


def pair_label(source: Column, target: Column) -> Column:
    """``<source>_to_<target>``."""
    return F.concat_ws("_to_", source, target)


def run_date_label(day: Column) -> Column:
    """Run date as used in output paths."""
    return F.date_format(day, "yyyy-MM-dd")
