"""Text of frames and transcripts: base forms and word runs inside the JVM, their reconciliation in Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Letters that decompose into one letter and marks, with that letter; then the marks, which go."""
    plain, of = [], []
    for c in map(chr, range(0x80, 0x2000)):
        d = unicodedata.normalize("NFD", c)
        rest = [x for x in d if not unicodedata.combining(x)]
        if d != c and len(rest) == 1 and len(d) > 1:
            plain.append(c)
            of.append(rest[0])
    marks = [c for c in map(chr, range(0x300, 0x370)) if unicodedata.combining(c)]
    return "".join(plain) + "".join(marks), "".join(of)


_FROM, _TO = _accents()
#: Python's strip() set, as a character class.
BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def base_form(text: Column) -> Column:
    """Lower case without diacritics; đ counts as d."""
    return F.translate(F.lower(F.translate(text, "đĐ", "dd")), _FROM, _TO)


def words(text: Column) -> Column:
    """Runs of letters, digits and _ in any script."""
    return F.regexp_extract_all(text, F.lit(r"(?U)(\w+)"), F.lit(1))


def find_run(hay: Column, needle: Column) -> Column:
    """0-based place of the first contiguous occurrence of an array in another; null if none, 0 for an empty needle."""
    n = F.size(needle)
    last = F.size(hay) - n
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    # the first word is compared alone; only where it fits the run is cut out
    fits = lambda i: (F.get(hay, i) == F.get(needle, F.lit(0))) & (F.slice(hay, i + 1, n) == needle)
    return F.when(n == 0, F.lit(0)).otherwise(F.get(F.filter(places, fits), F.lit(0)))


def is_upper(text: Column) -> Column:
    """At least one cased letter and none in lower case."""
    return (F.upper(text) == text) & (F.lower(text) != text)


_WORD = re.compile(r"\w+")
#: The usual marks, beyond which few texts have any; all marks; letters among which there may be others.
_USUAL, _MARKS = re.compile("[\u0300-\u034e\u0350-\u036f]+"), re.compile("[" + "".join(map(re.escape, filter(unicodedata.combining, map(chr, range(0x110000))))) + "]")
_BEYOND = re.compile("[^\x00-\u02ff]")


def _plain(s: str) -> str:
    """base_form of a string in Python."""
    s = s.translate({0x111: "d", 0x110: "d"}) if "\u0111" in s or "\u0110" in s else s
    s = s.lower()
    if s.isascii():
        return s
    s = _USUAL.sub("", unicodedata.normalize("NFD", s))
    return _MARKS.sub("", s) if _BEYOND.search(s) else s


def reconciled(base: str | None, vlm: str | None) -> str | None:
    """reconcile_lines of one text. The reading's base form is one string, words parted by blanks, and so is each line's."""
    if base is None or not vlm:
        return base
    said = _WORD.findall(vlm)
    hay = f" {_plain(' '.join(said))} "
    number, at = {}, 1  # of the word that begins at a place
    for k, w in enumerate(hay[1:-1].split(" ")):
        number[at] = k
        at += len(w) + 1
    lines = base.split("\n")
    own = [" ".join(_WORD.findall(x)) for x in lines]
    for k, (words_, needle) in enumerate(zip(own, _plain("\n".join(own)).split("\n"))):
        place = hay.find(f" {needle} ") if needle else -1
        if place >= 0:
            first = number[place + 1]
            text = " ".join(said[first : first + words_.count(" ") + 1])
            lines[k] = text.upper() if lines[k].isupper() else text
    return "\n".join(lines)


def reconcile_lines(base: Column, vlm: Column) -> Column:
    """Lines of `base` with the words of the vision model's text, where a line's word run occurs there but for case and marks.

    Such a line becomes those words, joined by blanks, in capitals if it was; others stay. Null vlm counts as ''.
    Texts go to Python in Arrow batches: the search of a run in a long text has no fast form in the JVM.
    """

    def run(base: pa.Array, vlm: pa.Array) -> pa.Array:
        return pa.array(map(reconciled, base.to_pylist(), vlm.to_pylist()), pa.string())

    return F.arrow_udf(run, "string")(base, vlm)


def normalize_transcript(text: Column) -> Column:
    return F.lower(strip(text))


def fill_blank(text: Column) -> Column:
    """A single blank for a text of nothing but white space."""
    return F.when(strip(text) == "", F.lit(" ")).otherwise(text)


def stored_path(path: Column, root: str) -> Column:
    """Path relative to the data root, if under it."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


def resolve_path(path: Column, root: str) -> Column:
    """Stored path made absolute again."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
