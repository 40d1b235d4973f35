"""Secret scans: candidate strings judged by a random forest.

A candidate is a run of 16 or more key characters with a digit or mixed case, or a value of 6 or more given to a key word, such as
a short or letters-only password. Features: length, kinds of characters,
transitions between kinds, coverage by dictionary words, whether it stands in a path or an assignment, and its
neighbouring words. The forest is trained from labelled findings; by default these come from a documented generator
(FINDINGS rows and half as many given values, fixed seed), or pass your own (context_before, token, context_after, is_secret).

Null and empty texts have no candidates. Spans are code points, ends exclusive, left to right, never overlapping. A very long text is
searched whole, in linear time. Repeated rows and rows with null or equal doc_ids each give their row, an empty table none; columns
besides the text (and n_chars, where it is one) are carried along or not looked at, whatever their names. A score of just the
threshold is a secret.
"""

from __future__ import annotations

import base64
import random
import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, small_batches, text_frame

FINDINGS = 4000
CONTEXT = 48
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}+={0,2}")
_CHANGE = re.compile(r"[0-9]")
_WORD = re.compile(r"[A-Za-z]{3,}")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
#: Words that stand near secrets, and near look-alikes.
NEAR = ("key", "token", "secret", "password", "passwd", "pwd", "auth", "bearer", "credential", "private", "access", "api")
FAR = ("sha", "commit", "checksum", "md5", "digest", "hash", "uuid", "guid", "etag", "revision", "integrity", "version", "path", "file", "example", "sample", "test", "dummy", "placeholder")
PREFIXES = ("AKIA", "ghp_", "gho_", "sk-", "sk_live_", "xoxb-", "xoxp-", "AIza", "glpat-", "eyJ", "npm_", "hf_")
PLACEHOLDERS = ("your", "change", "example", "sample", "dummy", "placeholder", "redacted", "none", "null", "true", "false", "xxx", "***", "...", "${", "%(", "<", "todo", "required", "optional")
_KEYS = r"pass(?:word|wd|phrase)|pwd|secret|token|(?:api|access|private|auth)[_-]?key|auth|credentials?|bearer"
_KEYS = rf"(?:{_KEYS})(?:[_-]?(?:key|value))?"
#: A value given to a key word: found whatever its length (6 at least) and letters.
_ASSIGNED = re.compile(rf"(?:{_KEYS})[\"']?[ \t]{{0,3}}(?:=>|:=|==?|:)[ \t]{{0,3}}[\"']?([^\s\"'`,;&<>()\[\]]{{6,}}+)", re.IGNORECASE)
_GIVEN = re.compile(rf"(?:{_KEYS})[\"']?[ \t]{{0,3}}(?:=>|:=|==?|:)[ \t]{{0,3}}[\"']?$", re.IGNORECASE)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@lru_cache(maxsize=4)
def vocabulary_words(path: str | None = None) -> frozenset[str]:
    """Dictionary for the coverage feature: the words of three and more letters that a public vocabulary has as pieces of their own.

    Some ten thousand words of its languages; read from the installed file, or one that you name.
    """
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = map(sp.id_to_piece, range(sp.get_piece_size()))
    return frozenset(p[1:].lower() for p in pieces if p[0] == "▁" and len(p) > 3 and p[1:].isalpha())


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3


def features(before: str, token: str, after: str, dictionary: frozenset[str] | None = None) -> list[float]:
    dictionary = vocabulary_words() if dictionary is None else dictionary
    n = len(token)
    kinds = [_kind(c) for c in token]
    share = [kinds.count(k) / n for k in range(4)]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    counts = np.bincount(np.frombuffer(token.encode("latin-1", "replace"), np.uint8))
    p = counts[counts > 0] / n
    low = token.lower()
    covered = sum(len(w) for w in _WORD.findall(_HUMP.sub(" ", token).lower()) if w in dictionary)
    longest = max((len(w) for w in _WORD.findall(token)), default=0)
    near = before[-CONTEXT:].lower()
    vowels = sum(c in "aeiou" for c in low) / max(1, sum(c.isalpha() for c in low))
    tail = near.rstrip(" \"'`")
    return [
        float(n), *share, turns, float(-(p * np.log2(p)).sum()), covered / n, longest / n, vowels,
        float(bool(_HEX.fullmatch(token))), float(token.count("/") + token.count("-") + token.count("_")),
        float(token.startswith(PREFIXES)), float(any(w in near for w in NEAR)), float(any(w in near for w in FAR)),
        float(tail.endswith(("=", ":", "=>"))), float(before[-1:] in "\"'`" and bool(before)), float(before[-1:] in "/." and bool(before) or after[:1] in ("/", "\\") or bool(re.match(r"\.[a-z]{2,4}\b", after))),
        float(low in dictionary), float(bool(_GIVEN.search(before))), max(map(token.count, set(token))) / n, float(any(w in low for w in PLACEHOLDERS)),
    ]


def generated_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """Labelled findings by rule: keys in assignments, headers and prose; against digests, ids, paths, names, prose."""
    rng = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    words = sorted(vocabulary_words())
    syllables = ("an", "er", "th", "ing", "tion", "ou", "en", "re", "ly", "ble", "st", "ha", "con", "de", "que", "ment", "ich", "ung", "ado", "ez")
    prose = lambda k: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(k))
    out = []
    for _ in range(n // 2):
        kind = rng.randrange(6)
        token = [
            lambda: some("0123456789abcdef", rng.choice((32, 40, 64))), lambda: some(alnum, rng.randint(20, 48)),
            lambda: base64.b64encode(rng.randbytes(rng.randint(18, 48))).decode(), lambda: rng.choice(PREFIXES) + some(alnum, rng.randint(16, 40)),
            lambda: some(alnum + "_-", rng.randint(24, 44)), lambda: some("0123456789ABCDEF", rng.choice((32, 40))),
        ][kind]()
        name = rng.choice(NEAR) if rng.random() < 0.6 else rng.choice(("api_key", "access_token", "SECRET_KEY", "client_secret", "AUTH_TOKEN", "db_password", "bearer"))
        join = rng.choice((' = "', "=", ": ", ": '", '": "', " => '", " "))
        quote = '"' if join.endswith('"') else "'" if join.endswith("'") else rng.choice(("", " ", "\n", "###", "&&&", "."))
        lead = prose(rng.randint(0, 6)) + rng.choice((" ", "\n", "### ", "export "))
        out.append(((lead + name + join)[-CONTEXT:], token, quote + " " + prose(2), 1))
        kind = rng.randrange(9)
        token, before, after = [
            lambda: (some("0123456789abcdef", rng.choice((40, 64))), rng.choice(FAR[:11]) + rng.choice((" ", ": ", "=")), ""),
            lambda: (some("0123456789abcdef", 8) + "-" + some("0123456789abcdef", 4) + "-4" + some("0123456789abcdef", 3) + "-a" + some("0123456789abcdef", 3) + "-" + some("0123456789abcdef", 12), rng.choice(("uuid ", "id: ", "guid=", "request ")), ""),
            lambda: ("/".join(rng.choice(words) for _ in range(rng.randint(3, 6))) + rng.choice(("", "/v2", "-2024", "1")), rng.choice(("path ", "./", "see ", "file: ", "/")), rng.choice((".py", ".html", ".txt", "/"))),
            lambda: (rng.choice("_-").join(rng.choice(words) for _ in range(rng.randint(3, 6))) + rng.choice(("_2", "-2023", "", "_v10")), prose(3) + " ", ""),
            lambda: ("".join(rng.choice(syllables) for _ in range(rng.randint(6, 14))), prose(4) + " ", "."),
            lambda: (some("0123456789", rng.randint(16, 26)), prose(3) + rng.choice((" ", " id ", " number ")), " "),
            lambda: ("".join(rng.choice(words).title() for _ in range(rng.randint(3, 6))) + rng.choice(("", "2", "V3")), rng.choice(("class ", "new ", "call ")), "("),
            lambda: (f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{some('012345', 2)}-{some('012345', 2)}-00", prose(2) + " ", ""),
            lambda: (rng.choice(("your", "example", "dummy", "test")) + rng.choice("-_") + rng.choice(("api", "secret", "access")) + rng.choice("-_") + rng.choice(("key", "token")) + rng.choice(("", "-here", "-123456")), rng.choice(NEAR) + "=", ""),
        ][kind]()
        out.append(((prose(rng.randint(0, 4)) + " " + before)[-CONTEXT:], token if len(token) >= 16 else token + "_" + token, after + " " + prose(2), 0))
        # values given to a key word: short or letters only, against words, names and placeholders
        key = rng.choice(("password", "passwd", "pwd", "secret", "token", "api_key", "auth_key", "DB_PASSWORD", "passphrase", "credentials"))
        join = rng.choice(('="', ": ", "=", ' = "', ": '", '": "', " => '", ":"))
        long = [w for w in (rng.choice(words) for _ in range(12)) if len(w) >= 6] or ["letters"]
        lead = (prose(rng.randint(0, 4)) + rng.choice((" ", "\n")) + key + join)[-CONTEXT:]
        quote = join[-1] if join[-1] in "\"'" else ""
        if rng.random() < 0.5:
            token = [
                lambda: rng.choice(words) + str(rng.randint(1, 9999)) + rng.choice(("", "!", "secret", "pass")), lambda: some(alnum, rng.randint(8, 15)), lambda: some(alnum[26:52], rng.randint(9, 20)),
                lambda: "".join(rng.choice(words) for _ in range(rng.randint(3, 5))), lambda: some(alnum + "!#$%*+?@^", rng.randint(8, 16)), lambda: rng.choice(words).title() + rng.choice("!@#$%_") + str(rng.randint(10, 2030)),
            ][rng.randrange(6)]()
            out.append((lead, token if len(token) >= 6 else token + "7Q" + token, quote + rng.choice(("", "\n", " ")) + prose(2), 1))
        else:
            token = [
                lambda: rng.choice(long), lambda: rng.choice(long) + rng.choice(".:!?"), lambda: rng.choice("x*.-") * rng.randint(6, 12), lambda: rng.choice(("changeme", "your_password", "example", "placeholder", "required", "redacted", "undefined", "disabled")),
                lambda: "${" + key.upper() + "}", lambda: rng.choice(("os.environ", "process.env." + key.upper(), "config." + key, "get_" + key, "self." + key)), lambda: "/".join(rng.choice(words) for _ in range(3)),
            ][rng.randrange(7)]()
            out.append((lead, token, quote + " " + prose(2), 0))
    return out


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1: leaf), threshold, left and right child, share of secrets. words: the dictionary they were grown with."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    words: frozenset[str] | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                live = f >= 0
                if not live.any():
                    break
                less = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
                at = np.where(live, np.where(less, left[at], right[at]), at)
            total += share[at]
        return total / max(1, len(self.trees))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 9, seed: int = 5) -> Forest:
    """Bootstrap samples, a random subset of the features at each split, Gini impurity over quantile thresholds."""
    rng, forest = np.random.default_rng(seed), []
    width = max(1, int(np.sqrt(x.shape[1])) + 1)
    for _ in range(trees):
        nodes: list[list[float]] = []

        def split(rows: np.ndarray, level: int, nodes=nodes) -> int:
            me, p = len(nodes), float(y[rows].mean())
            nodes.append([-1, 0.0, 0, 0, p])
            if level == depth or len(rows) < 8 or p in (0.0, 1.0):
                return me
            best = (1e9, 0, 0.0)
            for f in rng.choice(x.shape[1], width, replace=False):
                v = x[rows, f]
                cuts = np.unique(np.quantile(v, np.linspace(0.05, 0.95, 13)))
                for c in cuts[cuts < v.max()]:
                    a = v <= c
                    n = a.sum()
                    pa_, pb = y[rows[a]].mean(), y[rows[~a]].mean()
                    g = n * pa_ * (1 - pa_) + (len(rows) - n) * pb * (1 - pb)
                    if g < best[0]:
                        best = (g, int(f), float(c))
            if best[0] == 1e9:
                return me
            a = x[rows, best[1]] <= best[2]
            nodes[me][:2] = [best[1], best[2]]
            nodes[me][2] = split(rows[a], level + 1)
            nodes[me][3] = split(rows[~a], level + 1)
            return me

        split(rng.integers(0, len(x), len(x)), 0)
        t = np.array(nodes)
        forest.append((t[:, 0].astype(np.int64), t[:, 1], t[:, 2].astype(np.int64), t[:, 3].astype(np.int64), t[:, 4]))
    return Forest(forest)


def train(findings: list[tuple[str, str, str, int]] | None = None, dictionary: frozenset[str] | None = None) -> Forest:
    """A forest grown from labelled findings (context before, token, context after, is_secret); a dictionary of your own goes with it."""
    rows = findings if findings is not None else generated_findings()
    forest = grow(np.array([features(*r[:3], dictionary) for r in rows]), np.array([r[3] for r in rows], float))
    forest.words = vocabulary_words() if dictionary is None else dictionary
    return forest


def _own_length(value: str) -> int:
    """Length of value without sentence marks and runs of one sign at its end."""
    n = len(value)
    while n:
        c = value[n - 1]
        if c in "#*$%!" and value[n - 2 : n - 1] == c:
            while n and value[n - 1] == c:
                n -= 1
        elif c in ".:?":
            n -= 1
        else:
            break
    return n


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of runs of key characters, and of values given to a key word where no run is, in order."""
    out = _runs(text)
    starts = [a for a, _ in out]
    more = []
    for m in _ASSIGNED.finditer(text):
        a, b = m.start(1), m.start(1) + _own_length(m[1])
        b = b if b - a >= 6 else m.end(1)
        i = bisect_left(starts, b)
        if not (i and out[i - 1][1] > a) and not (more and more[-1][1] > a):
            more.append((a, b))
    return sorted(out + more)


def _runs(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _RUN.finditer(text):
        t = m[0]
        digits = bool(_CHANGE.search(t))
        if digits and not t.replace("-", "").replace("_", "").isdigit() or not digits and len(t) >= 20 and sum(c.isupper() for c in t) >= 3 and any(c.islower() for c in t):
            out.append(m.span())
    return out


def judge(text: str, forest: Forest, threshold: float) -> tuple[int, list[tuple[int, int, float]]]:
    """How many candidates text has, and the spans judged to be secrets with their scores."""
    spans = candidates(text)
    if not spans:
        return 0, []
    x = np.array([features(text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + 8], forest.words) for a, b in spans])
    p = forest.predict(x)
    return len(spans), [(a, b, float(s)) for (a, b), s in zip(spans, p, strict=True) if s >= threshold]


def scan(df: DataFrame, forest: Forest | None = None, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of df: n_candidates, n_secrets, spans as start:end:score, comma-joined, and the top score."""
    spread = df.sparkSession.sparkContext.broadcast(forest or train())  # size fixed by trees x depth

    def rows(part: pa.RecordBatch) -> dict:
        n, found = zip(*(judge(t or "", spread.value, threshold) for t in part.column(1).to_pylist()), strict=True)
        return {
            "doc_id": part.column(0), "n_candidates": pa.array(n, pa.int64()), "n_secrets": pa.array([len(f) for f in found], pa.int64()),
            "spans": pa.array([",".join(f"{a}:{b}:{s:.3f}" for a, b, s in f) for f in found], pa.string()), "top_score": pa.array([max((s for *_, s in f), default=0.0) for f in found], pa.float64()),
        }

    return mapped(text_frame(df, key, text), rows, "doc_id long, n_candidates long, n_secrets long, spans string, top_score double")


def without_secrets(df: DataFrame, forest: Forest | None = None, threshold: float = 0.5, mark: str = "<SECRET>") -> DataFrame:
    """df with each secret in text replaced by mark, and n_chars, where it is a column, set to the new length."""
    spread = df.sparkSession.sparkContext.broadcast(forest or train())
    names = small_batches(df).columns

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        found = judge(t, spread.value, threshold)[1]
        if not found:
            return t
        out, at = [], 0
        for a, b, _ in found:
            out += [t[at:a], mark]
            at = b
        return "".join(out) + t[at:]

    def run(batches):
        i = names.index("text")
        for batch in batches:
            kept = [clean(t) for t in batch.column(i).to_pylist()]
            batch = batch.set_column(i, "text", pa.array(kept, batch.column(i).type))
            if "n_chars" in names:
                j = names.index("n_chars")
                old = batch.column(j).to_pylist()
                batch = batch.set_column(j, "n_chars", pa.array([o if t is None else len(t) for o, t in zip(old, kept, strict=True)], batch.column(j).type))
            yield batch

    return df.mapInArrow(run, df.schema)
