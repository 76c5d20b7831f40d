"""Fill-in-middle transformation by counted-quantifier regular expressions.

A document is a run of units from its start on, code points unless another ``unit`` is given. ``regexp_count`` gives their number n, two
hashes of the document's id choose the cuts a <= b <= n, and a pattern made for the row, ``(unit{a})(unit{b-a})(rest)`` with
possessive quantifiers, captures prefix, middle and suffix in one match whose replacement is the output. Possessive counted
groups are loops in the regex engine, neither recursive nor backtracking, so texts may have any length.

Units are counted in blocks of 4,096, so that counting holds one string a block and not one a unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import free_prefix

CODE_POINT = r"(?s:.)"
MARKS = ("<P>", "<S>", "<M>")
_BLOCK = 4096


def count_units(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units follow each other from the text's start on. A unit must not match the empty string."""
    block = F.lit(rf"\G(?:{unit}){{{_BLOCK}}}+")
    rest = F.regexp_replace(text, block, F.lit(""))
    return F.regexp_count(text, block).cast("long") * _BLOCK + F.regexp_count(rest, F.lit(rf"\G(?:{unit})"))


def _quoted(mark: str) -> str:
    """A mark as a replacement's plain text."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def _digits(h: Column, k: int) -> Column:
    return F.conv(F.substring(h, 8 * k - 7, 8), 16, 10).cast("long")


def fill_middle(docs: DataFrame, text: str = "text", id_column: str = "doc_id", unit: str = CODE_POINT, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` with ``_n`` (units), ``_form`` (plain, psm or spm), ``_prefix_units`` and ``_middle_units`` (null if plain)
    and ``_output``; more underscores where the table has such columns.

    h1 to h4 are 8-digit groups of sha256 of ``seed:id``. The cuts are h1 and h2 modulo n + 1, in order. A text is plain if it
    is empty, holds a mark, or h3 % 100 falls into the last ``plain_percent``; else spm if h4 % 100 < ``spm_percent``, else
    psm. psm: prefix, suffix, middle; spm: suffix, prefix, middle, each after its mark (P, S, M). What no unit matches at the
    text's end stays in the suffix.

    A null text is empty: plain, output empty. A null id hashes like an empty one. Equal rows give equal results, an empty
    table none. Rows are independent: no shuffle, and nothing depends on their order. Texts are held whole, as Spark's
    regular expressions do.
    """
    p, (pre, suf, mid) = free_prefix(docs), marks
    c = lambda name: F.col(p + name)
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    out = docs.withColumns({p + "n": count_units(body, unit), p + "h": hashed})
    cuts = [_digits(c("h"), k) % (c("n") + 1) for k in (1, 2)]
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains(body, F.lit(m))
    plain = (c("n") == 0) | marked | (_digits(c("h"), 3) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(_digits(c("h"), 4) % 100 < spm_percent, "spm").otherwise("psm")
    out = out.withColumns({p + "a": F.least(*cuts), p + "b": F.greatest(*cuts), p + "form": form})
    unit_ = f"(?:{unit})"
    pattern = F.concat(F.lit(rf"\A({unit_}{{"), c("a").cast("string"), F.lit(rf"}}+)({unit_}{{"), (c("b") - c("a")).cast("string"), F.lit(r"}+)((?s:.)*+)"))
    psm, spm = _quoted(pre) + "$1" + _quoted(suf) + "$3" + _quoted(mid) + "$2", _quoted(suf) + "$3" + _quoted(pre) + "$1" + _quoted(mid) + "$2"
    made = F.regexp_replace(body, pattern, F.when(c("form") == "spm", spm).otherwise(psm))
    is_plain = c("form") == "plain"
    out = out.withColumns({p + "prefix_units": F.when(~is_plain, c("a")), p + "middle_units": F.when(~is_plain, c("b") - c("a")), p + "output": F.when(is_plain, body).otherwise(made)})
    return out.drop(p + "h", p + "a", p + "b")


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The exact text from an output and its form, by one match. Marks don't occur in texts that have been cut, so the first
    of each is the one that was set. A null output gives null."""
    pre, suf, mid = (rf"\Q{m}\E" for m in marks)
    part = "((?s:.)*?)"
    psm = F.regexp_replace(output, rf"\A{pre}{part}{suf}{part}{mid}((?s:.)*+)", "$1$3$2")
    spm = F.regexp_replace(output, rf"\A{suf}{part}{pre}{part}{mid}((?s:.)*+)", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
