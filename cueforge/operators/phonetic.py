"""Phonetic plausibility of character substitutions."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.strings import col

#: Initials that speech recognition confuses.
INITIAL_GROUPS = (
    ("zh", "z", "j"), ("ch", "c", "q"), ("sh", "s", "x"), ("n", "l"), ("r", "l"), ("f", "h"), ("b", "p"), ("d", "t"), ("g", "k"),
    ("j", "q", "x"), ("zh", "ch", "sh"), ("z", "c", "s"),
)
#: Finals that speech recognition confuses.
FINAL_GROUPS = (
    ("an", "ang"), ("en", "eng"), ("in", "ing"), ("ian", "iang"), ("uan", "uang"), ("an", "en"), ("ui", "un"), ("iu", "ou"), ("ei", "i"), ("ong", "eng"),
    ("iong", "ong"), ("uo", "o"), ("ai", "ei"), ("ou", "u"), ("ai", "a"), ("ei", "e"), ("ie", "i"), ("ue", "e"), ("ao", "iao"),
)
#: Initials of syllables, tried in this order.
INITIALS = ("zh", "ch", "sh", "b", "p", "m", "f", "d", "t", "n", "l", "g", "k", "h", "j", "q", "x", "r", "z", "c", "s", "y", "w")
_SPLIT = rf"(?s)\A({'|'.join(INITIALS)})?(.*)\z"
#: Han characters, as the class of that name in column functions.
HAN = re.compile("[\u2e80-\u2fd5々〇〡-〩〸-〻\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U000323af]")

#: A small table of readings without tones, of common characters; sources.readings loads larger ones. Unknown characters read as themselves.
SYLLABLES = {
    c: reading
    for reading, own in {
        "ta": "他它她塔踏", "zai": "在再載", "cai": "才菜猜", "shi": "是事時十市師室獅石食", "zhi": "知之只紙指", "ji": "級己記機幾", "wen": "問文聞溫", "hua": "話花化畫",
        "zhong": "中鐘重種", "lin": "林鄰", "ling": "玲零鈴", "ning": "寧", "min": "民", "xin": "新心信", "xing": "星行", "shan": "山", "shen": "身深", "sheng": "生聲", "fan": "飯反翻", "fen": "分份",
        "feng": "風封", "li": "裡理里力", "di": "地第低", "de": "的得", "dong": "東冬", "tong": "同通", "ren": "人", "reng": "仍", "yu": "魚雨語", "ma": "馬媽", "lan": "藍", "lang": "郎", "nan": "男南", "gua": "瓜", "hai": "海孩", "hei": "黑",
    }.items()
    for c in own
}


class Readings:
    """Readings of characters and of phrases (one syllable a character); where a phrase stands, its readings count.

    A table for Python workers, of many thousand entries; column functions take the map of syllable_map.
    """

    def __init__(self, table: dict[str, str]):
        self.chars = {k: v for k, v in table.items() if len(k) == 1}
        self.phrases = {k: own for k, v in table.items() if len(k) > 1 and len(own := v.split()) == len(k)}
        self.longest = max(map(len, self.phrases), default=1)

    def of(self, text: str) -> list[str]:
        """A reading for each Han character, by the longest phrase that begins there; a run of other characters is one element."""
        out, at = [], 0
        while at < len(text):
            if not HAN.match(text[at]):
                end = at
                while end < len(text) and not HAN.match(text[end]):
                    end += 1
                out.append(text[at:end])
                at = end
                continue
            size = next((k for k in range(min(self.longest, len(text) - at), 1, -1) if text[at : at + k] in self.phrases), 1)
            out += self.phrases[text[at : at + size]] if size > 1 else [self.chars.get(text[at], text[at])]
            at += size
        return out

    def alike(self, wrong: str | None, correct: str | None) -> bool:
        """As is_homophone."""
        if wrong is None or correct is None or len(wrong) != len(correct) or wrong == correct:
            return False
        wp, cp = self.of(wrong), self.of(correct)
        changed = [(a, b) for x, y, a, b in zip(wrong, correct, wp, cp) if x != y]
        return len(wp) == len(cp) and bool(changed) and all(similar(a, b) for a, b in changed)


def _parts(py: str) -> tuple[str, str]:
    head = next((i for i in INITIALS if py.startswith(i)), "")
    return head, py[len(head) :]


def similar(a: str, b: str) -> bool:
    """As similar_syllables, for Python workers."""
    if a == b:
        return True
    (ia, fa), (ib, fb) = _parts(a), _parts(b)
    together = lambda x, y, groups: any(x in g and y in g for g in groups)
    if ia == ib:
        return fa == fb or together(fa, fb, FINAL_GROUPS)
    return fa == fb and bool(ia and ib) and together(ia, ib, INITIAL_GROUPS)


def _groups(groups) -> Column:
    return F.from_json(F.lit(json.dumps(groups)), "array<array<string>>")


def initial(py: Column | str) -> Column:
    return F.regexp_extract(col(py), _SPLIT, 1)


def final(py: Column | str) -> Column:
    return F.regexp_extract(col(py), _SPLIT, 2)


def _grouped(a: Column, b: Column, groups) -> Column:
    """Whether one group has both. Groups share members, so this is no equivalence."""
    return F.exists(_groups(groups), lambda g: F.array_contains(g, a) & F.array_contains(g, b))


def similar_syllables(a: Column | str, b: Column | str) -> Column:
    """Equal, or one part equal and the other of one group. Two parts that differ are never similar."""
    a, b = col(a), col(b)
    ia, ib, fa, fb = initial(a), initial(b), final(a), final(b)
    alike = F.when((ia != "") & (ib != ""), (ia == ib) | _grouped(ia, ib, INITIAL_GROUPS)).otherwise(ia == ib)
    return (a == b) | ((ia == ib) & ((fa == fb) | _grouped(fa, fb, FINAL_GROUPS))) | (alike & (fa == fb))


def syllable_map(table: dict[str, str] | None = None) -> Column:
    """table as one constant of the plan."""
    table = SYLLABLES if table is None else table
    return F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "map<string,string>")


def readings(text: Column | str, syllables: Column) -> Column:
    """A reading for each Han character; a run of other characters is one element, itself."""
    parts = F.regexp_extract_all(col(text), F.lit(r"(\p{IsHan}|[^\p{IsHan}]+)"), F.lit(1))
    return F.transform(parts, lambda c: F.coalesce(F.try_element_at(syllables, c), c))


def phrase_syllables(text: Column | str, table: Readings) -> Column:
    """As readings, with the phrases of table, on Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else table.of(t) for t in text])

    return run(col(text))


def is_homophone(wrong: Column | str, correct: Column | str, syllables: Column | Readings | None = None) -> Column:
    """Same length, not equal, equally many readings, and every changed character similar to what it replaces.

    Characters and readings are matched by place, as far as the shortest list goes. With Readings, phrases count; this runs on
    Arrow batches.
    """
    wrong, correct = col(wrong), col(correct)
    if isinstance(syllables, Readings):

        @F.pandas_udf("boolean")
        def run(w: pd.Series, c: pd.Series) -> pd.Series:
            return pd.Series([syllables.alike(x, y) for x, y in zip(w, c, strict=True)], dtype=bool)

        return run(wrong, correct)
    syllables = syllable_map() if syllables is None else syllables
    wp, cp = readings(wrong, syllables), readings(correct, syllables)
    n = F.least(F.length(wrong), F.size(wp))
    cut = lambda a: F.slice(a, F.lit(1), n)
    zipped = F.arrays_zip(cut(F.split(wrong, "")).alias("wc"), cut(F.split(correct, "")).alias("cc"), cut(wp).alias("wp"), cut(cp).alias("cp"))
    changed = F.filter(zipped, lambda z: z["wc"] != z["cc"])
    ok = (F.size(changed) > 0) & F.forall(changed, lambda z: similar_syllables(z["wp"], z["cp"]))
    return F.coalesce(F.when((F.length(wrong) == F.length(correct)) & (wrong != correct) & (F.size(wp) == F.size(cp)), ok), F.lit(False))
