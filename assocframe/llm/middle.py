"""Fill-in-middle: documents cut into prefix, middle and suffix and put in another order, so that they can be restored.

A text is a row of units, each a run of ASCII letters or one other code point.
One ``fullmatch`` of ``(unit)*`` by the regex library keeps every repetition of
its group, so the length of ``ends(1)`` is the number of units and its items are
the places of all cuts; nothing iterates over units.

Every document is a row of its own: nothing is shuffled, and hot sources or
copies cost what their texts cost.  Odd cases: a NULL text is an empty one, an
empty text is plain with no units; a NULL id is written as nothing after the
salt; repeated rows give repeated results; other columns are not looked at, so
their names cannot clash; an empty table gives an empty one.  A very long text
is matched whole, piece by piece: the library's own stack limits one match to
some ten million code points, so texts over ``PIECE`` are matched in pieces that
end where a unit ends, and the places of the cuts are added up.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe.llm.common import map_rows

UNIT = r"[A-Za-z]+|[^A-Za-z]"
MARKERS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT = 10
SPM_PERCENT = 20
PIECE = 1 << 20

_UNITS = regex.compile(f"({UNIT})*")
_NO_LETTER = regex.compile(r"[^A-Za-z]")
_SCHEMA = "doc_id {id}, n long, form string, prefix string, middle string, suffix string"


def unit_ends(text: str, piece: int = PIECE) -> np.ndarray:
    """The place behind every unit of ``text``, in code points."""
    if len(text) <= piece:
        return np.asarray(_UNITS.fullmatch(text).ends(1), dtype=np.int64)
    found, start = [], 0
    while start < len(text):
        # Before a code point that is no letter there is always an end of a unit.
        at = _NO_LETTER.search(text, start + piece)
        end = at.start() if at else len(text)
        found.append(np.asarray(_UNITS.fullmatch(text, start, end).ends(1), dtype=np.int64))
        start = end
    return np.concatenate(found)


def cut(text: str, one: int, two: int) -> tuple[int, int, int]:
    """Number of units and the two places at which ``text`` is cut, given two draws."""
    ends = unit_ends(text)
    n = len(ends)
    first, second = sorted((one % (n + 1), two % (n + 1)))
    return n, *(int(ends[k - 1]) if k else 0 for k in (first, second))


def draws(doc_id: str = "doc_id", salt: str = "1:") -> list[Column]:
    """Four repeatable draws of 32 bits from the SHA-256 of salt and id."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def cut_documents(docs: DataFrame, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, prefix, middle and suffix of every document; a plain one is all prefix."""
    text = F.coalesce("text", F.lit(""))
    one, two, three, four = draws()
    plain = (text == "") | (three % 100 >= 100 - plain_percent)
    for marker in MARKERS:
        plain = plain | text.contains(marker)
    form = F.when(plain, "plain").when(four % 100 < spm_percent, "spm").otherwise("psm")
    drawn = docs.select("doc_id", text.alias("text"), form.alias("form"), one.alias("one"), two.alias("two"))

    def cut_rows(rows: list[dict]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "n": [], "form": [], "prefix": [], "middle": [], "suffix": []}
        for r in rows:
            text = r["text"]
            n, a, b = cut(text, r["one"], r["two"])
            if r["form"] == "plain":
                a = b = len(text)
            for name, value in zip(out, (r["doc_id"], n, r["form"], text[:a], text[a:b], text[b:])):
                out[name].append(value)
        return out

    return map_rows(drawn, cut_rows, _SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString()))


def output_text() -> Column:
    """The training text of a row of ``cut_documents``."""
    p, s, m = (F.lit(x) for x in MARKERS)
    psm = F.concat(p, "prefix", s, "suffix", m, "middle")
    spm = F.concat(s, "suffix", p, "prefix", m, "middle")
    return F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("prefix"))


def restored_text(output: str = "output", form: str = "form") -> Column:
    """The document again, from output and form alone.

    Only texts without a marker are reordered, and a marker cannot arise where
    two parts meet, so the first place of each marker is the one put there.
    """
    whole = F.col(output)
    middle = F.substring_index(whole, MARKERS[2], -1)
    head = F.substr(F.substring_index(whole, MARKERS[2], 1), F.lit(len(MARKERS[0]) + 1))
    at = F.when(F.col(form) == "psm", F.locate(MARKERS[1], head)).otherwise(F.locate(MARKERS[0], head))
    left, right = F.substr(head, F.lit(1), at - 1), F.substr(head, at + len(MARKERS[0]))
    psm, spm = F.concat(left, middle, right), F.concat(right, middle, left)
    return F.when(F.col(form) == "plain", whole).when(F.col(form) == "psm", psm).otherwise(spm)


def fill_in_middle(docs: DataFrame, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, prefix_chars and middle_chars (NULL if plain) and the ``output`` text of every document."""
    parts = cut_documents(docs, plain_percent, spm_percent)
    moved = F.col("form") != "plain"
    return parts.select(
        "doc_id", "n", "form",
        F.when(moved, F.length("prefix").cast("long")).alias("prefix_chars"),
        F.when(moved, F.length("middle").cast("long")).alias("middle_chars"),
        output_text().alias("output"),
    )
