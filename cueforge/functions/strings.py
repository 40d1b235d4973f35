"""String columns: trimming, cleaning, folds of replacements, edit distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, with the four separators that Java's class leaves out.
SPACE = r"[\s\x{1c}-\x{1f}]"
#: What character alignment leaves out besides white space.
PUNCTUATION = "，。、！？「」…⋯-（）()："
TAG = "<[^>]+>"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(col(c), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def lines(c: Column | str) -> Column:
    """Lines of a text, at every line end that Unicode knows."""
    return F.split(col(c), r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]")


def plain_newlines(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\r\n?", "\n")


def without_tags(c: Column | str) -> Column:
    return F.regexp_replace(col(c), TAG, "")


def first_of(*cs: Column | str) -> Column:
    """The first value that is neither null nor empty, else the last."""
    cs = [col(c) for c in cs]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs[:-1]], cs[-1])


def cleaned(c: Column | str) -> Column:
    """Without white space and the marks of PUNCTUATION; ASCII commas and the like stay."""
    inner = PUNCTUATION.replace("-", r"\-").replace("(", r"\(").replace(")", r"\)")
    return F.regexp_replace(col(c), rf"(?U)[\s\x{{1c}}-\x{{1f}}{inner}]", "")


def latin_runs(c: Column | str, least: int = 3) -> Column:
    """All runs of at least so many ASCII letters."""
    return F.regexp_extract_all(col(c), F.lit(f"([a-zA-Z]{{{least},}})"), F.lit(1))


def without_fences(c: Column | str) -> Column:
    """A model's reply without Markdown code fences."""
    return strip(F.regexp_replace(col(c), r"(?m)^```json\s*|^```\s*|```$", ""))


def without_reasoning(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), r"(?s)<think>.*?</think>", ""))


def normalized_levenshtein(a: Column | str, b: Column | str) -> Column:
    """Unit-cost edit distance over code points as a share of the longer text: 0 for equal texts, 1 against an empty one."""
    a, b = col(a), col(b)
    return F.when(a == b, 0.0).when((a == "") | (b == ""), 1.0).otherwise(F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def similarity(a: Column | str, b: Column | str) -> Column:
    return F.lit(1.0) - normalized_levenshtein(a, b)


def length_ratio(text: Column | str, original: Column | str) -> Column:
    return F.length(col(text)) / F.greatest(F.length(col(original)), F.lit(1))


def apply_substitutions(text: Column | str, subs: Column | str) -> Column:
    """Left fold of replace-first over array<struct<wrong, correct>>; each step sees what the steps before made."""

    def step(acc: Column, f: Column) -> Column:
        return F.when((F.position(f["wrong"], acc) > 0) & (f["wrong"] != f["correct"]), replace_first(acc, f["wrong"], f["correct"])).otherwise(acc)

    return F.aggregate(col(subs), col(text), step)


def replace_first(text: Column, wrong: Column, correct: Column) -> Column:
    """text, which has wrong, with the leftmost occurrence replaced."""
    return F.overlay(text, correct, F.position(wrong, text), F.length(wrong))


#: Pairs of which the reference text decides, as (member, other).
PAIRS = (("他", "它"),)


def normalise_pairs(text: Column | str, refs: Column | str, pairs=PAIRS) -> Column:
    """Every occurrence of one member changed to the other where refs has only the other. The first rule that fits wins."""
    text, refs = col(text), col(refs)
    out = None
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            rule = F.contains(text, F.lit(x)) & F.contains(refs, F.lit(y)) & ~F.contains(refs, F.lit(x))
            to = F.replace(text, F.lit(x), F.lit(y))
            out = F.when(rule, to) if out is None else out.when(rule, to)
    return text if out is None else out.otherwise(text)


def joined_texts(refs: Column | str, by: str = " ") -> Column:
    """Texts of an array of structs in the array's order; empty ones count."""
    return F.array_join(F.transform(col(refs), lambda r: r["text"]), by)
