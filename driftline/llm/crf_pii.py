"""Personal data by patterns and a linear-chain CRF over word shapes, decoded in numpy batches."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("O", *KINDS)
BASE = KINDS[:4]
FEATURES = 1 << 13
#: Sentences of the training table, made from the templates below by a fixed rule.
TRAIN_SENTENCES = 400

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is entered at its start only and never given back, so each scan is linear
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CANDIDATE = re.compile(r"\S+")
_MARK = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each ``@`` with the whole local part before it."""
    found, at, free = [], text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                free = domain.end()
                found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each base kind; a match that fails its check is dropped and not retried."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    if "@" in text:
        spans["email"] = emails(text)
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    spans["ip"].append(m.span())
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    spans["card"].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    spans["phone"].append(m.span())
    return spans


def shape(word: str) -> str:
    """Letters to X and x, digits to d, all else as it is; runs beyond four are cut to four."""
    out: list[str] = []
    run = 0
    for c in word[:64]:
        k = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        run = run + 1 if out and out[-1] == k else 1
        if run <= 4:
            out.append(k)
    return "".join(out)


def features(before: str, word: str, after: str, earlier: str) -> list[int]:
    """Hashed word-shape features of a token in its context."""
    s = shape(word)
    short = re.sub(r"(.)\1+", r"\1", s)
    size = min(8, len(word).bit_length())
    digits = min(8, sum(map(str.isdigit, word)).bit_length())
    names = (
        "b", "s=" + s, "c=" + short, f"n={size}", f"d={digits}", f"sn={short}|{size}", f"dn={digits}|{size}",
        "p=" + shape(before), "w-1=" + before.lower(), "w-2=" + earlier.lower(), "q=" + shape(after),
        "w+1=" + after.lower(), "ps=" + shape(before) + "|" + short, "wc=" + before.lower() + "|" + short,
    )
    return [crc32(n.encode("utf-8", "surrogatepass")) % FEATURES for n in names]


# ---- the small labelled table ------------------------------------------------------------
# Sentence templates; {kind} is a labelled slot, <name> an unlabelled one.
TEMPLATES = (
    "please write to {email} today", "contact : {email} , thanks", "mail {email} or call {phone}",
    "server {ip} went down", "login from {ip} at <time>", "host {ip} answered in <number> ms",
    "card number {card} expires <date>", "charge {card} for <price>", "pay with {card} now",
    "call {phone} before noon", "phone : {phone}", "reach me at {phone} or {email}", "tel {phone} ext <number>",
    'token = "{secret}"', 'api_key = "{secret}"', "secret : {secret}", 'password = "{secret}"', "key {secret} leaked",
    'token = "{secret}" and text goes on', "export TOKEN = {secret}", "authorization bearer {secret}",
    "order <order> shipped on <date>", "version <version> of the license", "in <year> there were <number> cases",
    "chapter <number> , page <number>", "the price was <price> in <year>", "see section <version>",
    "isbn <isbn> printed <year>", "commit <short> fixes issue <number>", "room <code> at <time>",
    "scores were <number> to <number>", "Licensed under CC BY-NC <version>", "flight <code> leaves at <time>",
    'value = "<number>"', "id = <order>", "the handle @<name> wrote", "<number> people and <number> dogs",
    "General Public License, version <number>.", "population <big> in <year>",
)


def _slot(kind: str, r: random.Random) -> str:
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    if kind == "email":
        return r.choice((f"{letters(5)}.{d(2)}@mail{d(1)}.{letters(6)}.com", f"{letters(6)}@{letters(5)}.org", f"{letters(4)}_{letters(3)}@{letters(6)}", f"{letters(5)}@localhost"))
    if kind == "ip":
        return ".".join(str(r.randrange(1, 255)) for _ in range(4))
    if kind == "card":
        n = d(16)
        return r.choice((n, f"{n[:4]} {n[4:8]} {n[8:12]} {n[12:]}", f"{n[:4]}-{n[4:8]}-{n[8:12]}-{n[12:]}"))
    if kind == "phone":
        a, b, c = d(3), d(3), d(4)
        return r.choice((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{d(2)} {a} {b}{c}", f"{a}.{b}.{c}", f"+1 {a} {b} {c}"))
    if kind == "secret":
        hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
        mixed = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
        upper = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
        return r.choice((hexes(40), hexes(40), hexes(32), hexes(64), mixed(32), "AKIA" + upper, "ghp_" + mixed(36), "sk-" + mixed(40), hexes(40).upper()))
    return {
        "time": f"{d(2)}:{d(2)}", "number": d(r.randrange(1, 4)), "date": f"20{d(2)}-{d(2)}-{d(2)}", "price": f"${d(2)}.{d(2)}",
        "order": d(r.choice((6, 8, 10, 12))), "version": r.choice((f"{d(1)}.0.", f"{d(1)}.{d(1)}", f"{d(1)}.{d(1)}.{d(2)}", f"{d(1)}.")),
        "year": r.choice(("19", "20")) + d(2), "isbn": f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", "short": d(1) + "".join(r.choice("0123456789abcdef") for _ in range(6)),
        "code": letters(1).upper() + d(3), "name": letters(6), "big": f"{d(1)},{d(3)},{d(3)}",
    }[kind]


def labelled_table(sentences: int = TRAIN_SENTENCES, seed: int = 5) -> list[tuple[list[str], list[int]]]:
    """(tokens, label numbers) of each sentence; some have punctuation or marks after the slot."""
    r = random.Random(seed)
    rows = []
    for i in range(sentences):
        text = TEMPLATES[i % len(TEMPLATES)]
        tokens: list[str] = []
        labels: list[int] = []
        junk = r.choice(("", "", "", ",", ".", "!!", "***", "&&&", "$$$", "###", "%%%"))
        for part in re.split(r"(\S*[{<]\w+[}>]\S*)", text):
            m = re.fullmatch(r"(\S*?)([{<])(\w+)[}>](\S*)", part)
            if not m:
                tokens += part.split()
                labels += [0] * len(part.split())
                continue
            words = (m[1] + _slot(m[3], r) + m[4]).split()
            words[-1] += junk
            tokens += words
            labels += [LABELS.index(m[3]) if m[2] == "{" else 0] * len(words)
        if r.random() < 0.1:
            tokens = [t.upper() for t in tokens]
        rows.append((tokens, labels))
    return rows


@dataclass
class Chain:
    """Emission weights by feature and label, and transition weights between labels."""

    emit: np.ndarray
    trans: np.ndarray


def _segments(words: list[str]) -> list[tuple[int, int]]:
    """Runs of tokens that hold a digit or an ``@``; every other token is O by definition."""
    runs, begin = [], None
    for i, w in enumerate(words):
        if _MARK.search(w):
            begin = i if begin is None else begin
        elif begin is not None:
            runs.append((begin, i))
            begin = None
    if begin is not None:
        runs.append((begin, len(words)))
    return runs


def _encode(words: list[str], a: int, b: int) -> np.ndarray:
    at = lambda i: words[i] if 0 <= i < len(words) else ""
    return np.array([features(at(i - 1), words[i], at(i + 1), at(i - 2)) for i in range(a, b)], np.int64)


def train(rows: list[tuple[list[str], list[int]]], epochs: int = 6, rate: float = 0.2, seed: int = 1) -> Chain:
    """Maximise the conditional log-likelihood by stochastic gradients (forward-backward in logs)."""
    rng = np.random.default_rng(seed)
    n = len(LABELS)
    width = len(features("", "x", "", ""))
    emit, trans = np.zeros((FEATURES, n)), np.zeros((n, n))
    data = [(_encode(w, a, b), np.array(y[a:b])) for w, y in rows for a, b in _segments(w)]
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for i in rng.permutation(len(data)):
            f, y = data[i]
            e = emit[f].sum(1)
            t = len(y)
            # the chain begins and ends in O
            alpha = np.zeros((t, n))
            alpha[0] = trans[0] + e[0]
            for k in range(1, t):
                alpha[k] = np.logaddexp.reduce(alpha[k - 1][:, None] + trans, 0) + e[k]
            beta = np.zeros((t, n))
            beta[-1] = trans[:, 0]
            for k in range(t - 2, -1, -1):
                beta[k] = np.logaddexp.reduce(trans + e[k + 1] + beta[k + 1], 1)
            z = np.logaddexp.reduce(alpha[-1] + beta[-1])
            marginal = np.exp(alpha + beta - z)
            g = -marginal
            g[np.arange(t), y] += 1
            dt = np.zeros((n, n))
            dt[0] += g[0]
            dt[:, 0] += g[-1]
            for k in range(1, t):
                both = np.exp(alpha[k - 1][:, None] + trans + e[k] + beta[k] - z)
                dt -= both
                dt[y[k - 1], y[k]] += 1
            np.add.at(emit, f.ravel(), np.repeat(step * g, width, 0) / 4)
            trans += step * dt
        emit *= 1 - 1e-3
    return Chain(emit, trans)


def viterbi(chain: Chain, segments: list[np.ndarray]) -> list[np.ndarray]:
    """Best labels of each segment; segments of one length are decoded together."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(segments)
    by: dict[int, list[int]] = {}
    for i, s in enumerate(segments):
        by.setdefault(len(s), []).append(i)
    for t, group in by.items():
        for a in range(0, len(group), max(1, 200_000 // t)):
            part = group[a : a + max(1, 200_000 // t)]
            e = chain.emit[np.stack([segments[i] for i in part])].sum(2)
            back = np.zeros((t, len(part), len(LABELS)), np.int8)
            v = chain.trans[0] + e[:, 0]
            for k in range(1, t):
                way = v[:, :, None] + chain.trans
                back[k] = way.argmax(1)
                v = way.max(1) + e[:, k]
            y = np.zeros((t, len(part)), np.int64)
            y[-1] = (v + chain.trans[:, 0]).argmax(1)
            for k in range(t - 1, 0, -1):
                y[k - 1] = back[k, np.arange(len(part)), y[k]]
            for j, i in enumerate(part):
                out[i] = y[:, j]
    return out


#: Digits that a phone or card number has at most; each token of a run holds one at least.
MOST_DIGITS = 19
_EDGE = "\"'`.,;:!?#$%&*|<>[]{}=~^"


def _accepted(kind: str, s: str) -> bool:
    """What a decoded span must hold to be reported."""
    digits = sum(map(str.isdigit, s))
    if kind == "email":
        return 0 < s.find("@") < len(s) - 1
    if kind == "ip":
        return s.count(".") == 3 and all(p.isdigit() and int(p) <= 255 for p in s.split(".") if len(p) <= 3) and all(0 < len(p) <= 3 for p in s.split("."))
    if kind == "card":
        plain = s.replace(" ", "").replace("-", "")
        return plain.isascii() and plain.isdigit() and 13 <= len(plain) <= 19 and luhn(plain)
    if kind == "phone":
        return 9 <= digits <= 15 and all(c.isdigit() or c in "+() .-" for c in s)
    return len(s) >= 16 and digits >= 2 and " " not in s


def _clear(spans: list[tuple[int, int]]):
    """Whether a range overlaps none of the spans, each asked by one search."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def clear(a: int, b: int) -> bool:
        i = bisect_left(starts, b) - 1
        return i < 0 or ends[i] <= a

    return clear


def _numbers(text: str, spans: list[tuple[int, int]], find) -> list[tuple[int, int]]:
    """The phone or card numbers in a run of neighbouring tokens, by ``find(a, b)`` (a number's range or None).

    The whole run counts if it can. Else it is cut where a line ends or a ``+``
    begins, and the numbers that cover most tokens are taken; among equals those of
    the most even lengths.
    """
    whole = find(spans[0][0], spans[-1][1]) if len(spans) <= MOST_DIGITS else None
    if whole:
        return [whole]
    digits = [sum(map(str.isdigit, text[a:b])) for a, b in spans]
    n = len(spans)
    cut = [k == 0 or "\n" in text[spans[k - 1][1] : spans[k][0]] or text[spans[k][0] : spans[k][1]].lstrip(_EDGE + "(").startswith("+") for k in range(n)]
    # best[k]: tokens covered, minus squares of digits, of the first k tokens; way[k]: where the last number begins
    best, way = [(0, 0)] * (n + 1), [None] * (n + 1)
    for k in range(1, n + 1):
        best[k] = best[k - 1]
        total = 0
        for j in range(k - 1, max(-1, k - 1 - MOST_DIGITS), -1):
            total += digits[j]
            if total > MOST_DIGITS:
                break
            covered = (best[j][0] + k - j, best[j][1] - total * total)
            if covered > best[k] and find(spans[j][0], spans[k - 1][1]):
                best[k], way[k] = covered, j
            if cut[j]:
                break
    out, k = [], n
    while k:
        if way[k] is None:
            k -= 1
        else:
            out.append(find(spans[way[k]][0], spans[k - 1][1]))
            k = way[k]
    return out[::-1]


def added_spans(chain: Chain, texts: list[str], base: list[dict[str, list[tuple[int, int]]]]) -> list[list[tuple[str, int, int]]]:
    """Spans that the chain finds beside the base ones; none overlaps a base span or another."""
    segments, owners = [], []
    for d, t in enumerate(texts):
        if not _MARK.search(t):
            continue
        matches = list(_CANDIDATE.finditer(t))
        words = [m.group() for m in matches]
        for a, b in _segments(words):
            segments.append(_encode(words, a, b))
            owners.append((d, [m.span() for m in matches[a:b]]))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    free: dict = {}
    for (d, spans), y in zip(owners, viterbi(chain, segments), strict=True):
        k = 0
        while k < len(y):
            j = k + 1
            while j < len(y) and y[j] == y[k]:
                j += 1
            if y[k]:
                kind, text = KINDS[y[k] - 1], texts[d]
                clear = free[d] = free.get(d) or _clear([x for v in base[d].values() for x in v])

                def find(a: int, b: int, kind=kind, text=text, clear=clear) -> tuple[int, int] | None:
                    s = text[a:b]
                    a, b = a + len(s) - len(s.lstrip(_EDGE)), b - len(s) + len(s.rstrip(_EDGE))
                    return (a, b) if a < b and _accepted(kind, text[a:b]) and clear(a, b) else None

                if kind in ("phone", "card"):
                    out[d] += [(kind, *x) for x in _numbers(text, spans[k:j], find)]
                else:
                    out[d] += [(kind, *x) for x in (find(a, b) for a, b in spans[k:j]) if x]
            k = j
    return out


#: Rows of a given labelled table that training reads at most.
MAX_LABELLED = 20_000


def _rows_of(labelled: DataFrame) -> list[tuple[list[str], list[int]]]:
    """Sentences of a labelled table: tokens and labels, arrays of strings.

    Rows in which either is null are left out. A row with more tokens than labels or fewer, a
    null token, or a label that is null or unknown is refused. Of more than MAX_LABELLED
    rows those with the smallest hashes are taken, the same in every run. Tokens without a
    digit or an ``@`` are outside whatever their label.
    """
    number = {k: i for i, k in enumerate(LABELS)}
    some = labelled.select("tokens", "labels").filter("tokens is not null and labels is not null")
    rows = some.orderBy(F.xxhash64("tokens", "labels"), F.to_json("tokens"), F.to_json("labels")).limit(MAX_LABELLED).collect()
    for r in rows:
        if len(r["tokens"]) != len(r["labels"]):
            raise ValueError(f"a labelled row has {len(r['tokens'])} tokens and {len(r['labels'])} labels")
        if any(x is None for x in r["tokens"]):
            raise ValueError("a labelled row holds a null token")
        if unknown := sorted({str(x) for x in r["labels"]} - set(LABELS)):
            raise ValueError(f"labels other than {', '.join(LABELS)}: {', '.join(unknown)}")
    return [(r["tokens"], [number[x] for x in r["labels"]]) for r in rows]


def _model(docs: DataFrame, sentences: int, labelled: DataFrame | None):
    rows = labelled_table(sentences) if labelled is None else _rows_of(labelled)
    return docs.sparkSession.sparkContext.broadcast(train(rows))


def _all_spans(chain: Chain, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, base) of each text, by kind as listed, then start."""
    order = {k: i for i, k in enumerate(KINDS)}
    base = [base_spans(t) for t in texts]
    out = []
    for b, more in zip(base, added_spans(chain, texts, base), strict=True):
        every = [(k, s, e, True) for k in BASE for s, e in b[k]] + [(k, s, e, False) for k, s, e in more]
        out.append(sorted(every, key=lambda x: (order[x[0]], x[1])))
    return out


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = TRAIN_SENTENCES, labelled: DataFrame | None = None
) -> DataFrame:
    """doc_id and spans (kind, start, end, base) of every row, over whole texts.

    Base spans follow fixed patterns and checks; the chain, trained from the small
    ``labelled`` table (tokens, labels; MAX_LABELLED rows at most, malformed ones are refused) or, without one, from
    that of this module, adds addresses, numbers and secrets that the patterns do not
    cover and that overlap no base span. Tokens without a digit or
    an ``@`` are outside by definition, so the Viterbi search runs over the other
    runs, which it decodes in batches. Offsets are code points, the end is exclusive.

    Nulls: a null text is empty; rows without an id and repeated rows are searched
    each. An empty table gives no rows. Only the two named columns are read.
    """
    model = _model(docs, sentences, labelled)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                [{"kind": k, "start": s, "end": e, "base": f} for k, s, e, f in every]
                for every in _all_spans(model.value, frame["text"].tolist())
            ]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "spans": rows})

    return id_and_text(docs, id_col, text_col).mapInPandas(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"
    )


def mask(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with every span replaced by its kind in angle brackets; spans that overlap go as one, under the first's kind."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = TRAIN_SENTENCES, labelled: DataFrame | None = None
) -> DataFrame:
    """doc_id and the text with every span of :func:`find_pii` replaced by its kind in angle brackets.

    A text is masked by the task that searches it, so each row gives one row whatever
    its id: rows without an id and rows that repeat one are masked each. A null text
    is empty. An empty table gives no rows.
    """
    model = _model(docs, sentences, labelled)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            clean = [mask(t, spans) for t, spans in zip(texts, _all_spans(model.value, texts), strict=True)]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "text": clean})

    return id_and_text(docs, id_col, text_col).mapInPandas(run, "doc_id long, text string")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans, SHA-256 of them, all spans as one string, counts of added spans, and whether there is any."""
    word = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    more = F.filter("spans", lambda s: ~s["base"])
    added = lambda k: F.size(F.filter(more, lambda s: s["kind"] == k)).cast("long").alias(f"n_added_{k}")
    return found.select(
        "doc_id", *(count(k) for k in BASE),
        F.sha2(F.array_join(F.transform(base, word), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", word), ",").alias("spans"),
        *(added(k) for k in KINDS),
        (F.size("spans") > 0).alias("has_pii"),
    )
