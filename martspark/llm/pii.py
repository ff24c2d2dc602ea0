"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

Base spans come from fixed patterns. The field adds spans that no pattern finds, such as access
tokens: it is trained with numpy from a small labelled table, and labels the words of each line by
Viterbi in batches. Added spans never touch a base span.

Null text: empty, no spans. Null doc_id: kept. Very long text: labelled line by line, lines of one
length in batches. Repeated rows and ties: a result each. Other columns are not
read, but ``redact`` carries them along. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
LABELS = ("", *KINDS)
TRAIN_ROWS = 5000       # most rows of the labelled table that are used, by hash of the text

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ looked at once: the run before it, the domain behind it."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        start = at
        while m and start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", *x) for x in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# ---- word shapes ------------------------------------------------------------------------------

_DIGIT, _HEX, _PLAIN = C.table_of(b"0123456789"), C.table_of(b"0123456789abcdefABCDEF"), C.table_of(b".,;:!?|()\"'-")
_ALPHA = C.table_of(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_AT, _DOT, _DASH, _EQ, _PLUS = (C.table_of(x) for x in (b"@", b".", b"-", b"=:", b"+"))
_QUOTE = C.table_of(b"\"'.,;:!?()|#$%&*<>[]{}")
_UPPER, _WIDE = C.table_of(bytes(range(65, 91))), C.table_of(bytes(range(128, 256)))
# words that announce a secret, and those that announce a hash that is none
CONTEXT = ("token", "key", "secret", "password", "passwd", "pwd", "apikey", "api_key", "access_key", "secret_key", "auth", "=", ":", "bearer",
           "commit", "revision", "hash", "sha1", "sha256", "md5", "checksum", "digest", "etag", "uuid")
LONGEST = max(map(len, CONTEXT)) + 1        # with a sign behind
SHAPES = 6 * 3 * 2 * 2 * 2 * 4 * 2 * 3 + 2 * len(CONTEXT) + 1


@functools.lru_cache(1)
def context_hashes() -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode() for w in CONTEXT]
    ends = np.cumsum([len(w) for w in raw])
    h = C.span_hashes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], ends[:-1]]), ends)[0]
    order = np.argsort(h)
    return h[order], order


def shapes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A number for the shape of each word: digits, letters, an @, inner dots or dashes, whether
    all is hexadecimal, length (of words with a digit, and of long ASCII words without), a plus, the case of
    long words; words that announce a secret or a hash have numbers of their own, with and without
    a : or = behind them. 0 for plain words."""
    def count(mask):
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return sums[e] - sums[s]
    digits, alpha, size = count(_DIGIT[data]), count(_ALPHA[data]), e - s
    core = size - count(_QUOTE[data])
    out = np.searchsorted([1, 4, 8, 13, 20], digits, "right")
    mixed = np.where(alpha == 0, 1, np.where(digits > 0, 2, 0))
    out = out * 3 + mixed
    out = out * 2 + (count(_AT[data]) > 0)
    out = out * 2 + (((count(_DOT[data]) > 1) | (count(_DASH[data]) > 3)) & (digits > 0))
    hexa = (count(_HEX[data]) >= core) & (digits > 0) & (alpha > 0)
    out = out * 2 + hexa
    upper, wide = count(_UPPER[data]), count(_WIDE[data])
    case = np.where(upper < 2, 0, np.where(upper == alpha, 2, np.where(alpha - upper < 2, 0, 1)))
    case[(core < 16) | (wide > 0) | hexa] = 0
    long = (digits > 0) | (case > 0) | ((core >= 24) & (alpha >= core) & (wide == 0))
    out = out * 4 + np.where(long, np.searchsorted([8, 16, 32], core, "right"), 0)
    out = out * 2 + (count(_PLUS[data]) > 0)
    out = out * 3 + case
    h, order = context_hashes()
    short = np.flatnonzero(size <= LONGEST)
    lower = C.LOWER[data]
    sign = (size[short] > 1) & _EQ[data[e[short] - 1]]
    own = C.span_hashes(lower, s[short], e[short] - sign)[0]
    at = np.minimum(np.searchsorted(h, own), len(h) - 1)
    hit = h[at] == own
    out[short[hit]] = SHAPES - 2 * len(CONTEXT) - 1 + 2 * order[at[hit]] + sign[hit]
    return out


class Field:
    """Weights: of a word's shape, of its neighbours' shapes two words either way, of label pairs."""

    REACH = (-2, -1, 0, 1)

    def __init__(self):
        self.own = np.zeros((len(self.REACH), SHAPES + 1, len(LABELS)))      # SHAPES: beyond the line
        self.step = np.zeros((len(LABELS), len(LABELS)))

    def emissions(self, padded: np.ndarray) -> np.ndarray:
        """Scores (line, word, label) of shape numbers (line, word)."""
        b, n = padded.shape
        wide = np.full((b, n + 4), SHAPES)
        wide[:, 2:n + 2] = padded
        return sum(self.own[k][wide[:, 2 + d:2 + d + n]] for k, d in enumerate(self.REACH))

    def viterbi(self, padded: np.ndarray) -> np.ndarray:
        """Best labels of lines of one length."""
        score = self.emissions(padded)
        b, n, _ = score.shape
        back = np.zeros((b, n, len(LABELS)), np.int8)
        best = score[:, 0]
        for t in range(1, n):
            through = best[:, :, None] + self.step
            back[:, t] = through.argmax(axis=1)
            best = through.max(axis=1) + score[:, t]
        out = np.zeros((b, n), np.int8)
        out[:, -1] = best.argmax(axis=1)
        rows = np.arange(b)
        for t in range(n - 1, 0, -1):
            out[:, t - 1] = back[rows, t, out[:, t]]
        return out

    def fit(self, lines: list[tuple[np.ndarray, np.ndarray]], rounds: int = 60, rate: float = 0.3, decay: float = 1e-3) -> Field:
        """Maximum conditional likelihood by forward-backward and Adam; lines of a length together."""
        groups: dict[int, list] = {}
        for x, y in lines:
            groups.setdefault(len(x), []).append((x, y))
        batches = [(np.array([x for x, _ in g]), np.array([y for _, y in g])) for n, g in sorted(groups.items()) if n]
        total = sum(x.size for x, _ in batches)
        state = [(w, np.zeros_like(w), np.zeros_like(w)) for w in (self.own, self.step)]
        for t in range(1, rounds + 1):
            grads = [decay * w * total / 100 for w, _, _ in state]
            for x, y in batches:
                self._gradient(x, y, *grads)
            for (w, m, v), g in zip(state, grads):
                g /= total
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        return self

    def _gradient(self, x, y, g_own, g_step) -> None:
        score = self.emissions(x)
        b, n, k = score.shape
        fore = np.zeros_like(score)
        fore[:, 0] = score[:, 0]
        lse = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
        for t in range(1, n):
            fore[:, t] = lse(fore[:, t - 1][:, :, None] + self.step, 1) + score[:, t]
        hind = np.zeros_like(score)
        for t in range(n - 2, -1, -1):
            hind[:, t] = lse(self.step + (score[:, t + 1] + hind[:, t + 1])[:, None, :], 2)
        z = lse(fore[:, -1], 1)
        post = np.exp(fore + hind - z[:, None, None])
        post[np.arange(b)[:, None], np.arange(n), y] -= 1
        wide = np.full((b, n + 4), SHAPES)
        wide[:, 2:n + 2] = x
        for j, d in enumerate(self.REACH):
            at = wide[:, 2 + d:2 + d + n].ravel()
            for own, p in zip(g_own[j].T, post.reshape(-1, k).T):
                own += np.bincount(at, p, SHAPES + 1)
        for t in range(1, n):
            pair = np.exp(fore[:, t - 1][:, :, None] + self.step + (score[:, t] + hind[:, t])[:, None, :] - z[:, None, None])
            g_step += pair.sum(axis=0)
            np.subtract.at(g_step, (y[:, t - 1], y[:, t]), 1)


def labelled_table(spark: SparkSession, rows: int = 2400, seed: int = 7) -> DataFrame:
    """A small labelled table (text, spans array of (kind, start, end)), made by rule. Hexadecimal
    strings, access keys and long strings of mixed case are secrets anywhere but after a word such
    as ``commit``; short and letter-only ones only after a word such as ``password`` and a sign."""
    rng = random.Random(seed)
    part = ["an", "the", "re", "tion", "ou", "ber", "kei", "ción", "eau", "sch", "lo", "mi", "vi", "st", "wh", "er"]
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    some = lambda of, n: "".join(rng.choice(of) for _ in range(n))

    def word():
        w = "".join(rng.choice(part) for _ in range(rng.randint(1, 5)))
        w = rng.choice([w, w, w, w.title(), w.upper()])
        return w + rng.choice(["", "", "", "", ",", ".", "!!", "###", "%%%", " |"])

    def value(kind):
        if kind == "email":
            return f"{word().strip(',.!#% |').lower() or 'a'}.{digits(2)}@{rng.choice(part)}{digits(1)}.example.{rng.choice(['com', 'org'])}"
        if kind == "ip":
            return ".".join(str(rng.randint(0, 255)) for _ in range(4))
        if kind == "card":
            return rng.choice(["", "", " ", "-"]).join(digits(4) for _ in range(4))
        if kind == "phone":
            return rng.choice([f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}", f"+{digits(2)} {digits(3)} {digits(7)}", f"+{digits(11)}"])
        if kind == "told":
            return rng.choice([some(lower, 32), some(lower + upper, 32), some(lower, 28), word().strip(",.!#% |").lower() + digits(rng.randint(1, 3)), some(lower + upper, rng.randint(4, 9)) + digits(1) + some(lower + upper + "0123456789", 4),
                               digits(1) + hexa(rng.randint(6, 18)) + "f", some(lower + "0123456789", rng.randint(20, 40))]).replace("===", "") or "a1"
        body = rng.choice([hexa(40), hexa(32), hexa(64), "sk" + hexa(30), hexa(20) + hexa(20).upper(), some(upper, 4) + some(upper + "0123456789", 16),
                           some(lower + upper + "0123456789+/", 40), some(lower + upper + "0123456789", rng.randint(24, 48))])
        return body if any(c.isdigit() for c in body) and any(c.isalpha() for c in body) else "a1" + body

    def no_secret():
        """Of a secret's look."""
        if rng.random() < 0.35:
            return f"{rng.choice(['commit', 'Commit', 'revision', 'sha1', 'md5', 'hash', 'etag', 'digest', 'sha256', 'checksum'])}{rng.choice(['', ':', ' =', ' :'])} {hexa(rng.choice([32, 40, 64]))}"
        return rng.choice(["-".join(hexa(n) for n in (8, 4, 4, 4, 12)), "".join(rng.choice(part) for _ in range(14)), "".join(rng.choice(part).title() for _ in range(9)),
                           some(upper, rng.randint(16, 30)), "https://" + ".".join(rng.choice(part) for _ in range(3)) + "/" + "".join(rng.choice(part) for _ in range(9)),
                           f"{rng.choice(['key', 'token', 'secret', 'password', 'auth'])}{rng.choice([' = ', ': ', ' '])}{word().lower()} {word().lower()}", f"key {digits(2)}", f"the token {digits(1)}", "password is " + word()])

    def plain():
        return rng.choice([str(rng.randint(0, 2100)), f"{rng.randint(0, 9)}.{rng.randint(0, 9)}", f"version {rng.randint(0, 9)}", f"{digits(1)},{digits(3)}", f"{digits(1)}th",
                           f"{digits(2)}%", f"p{digits(3)}", f"cafe{digits(2)}", "token", "key", "secret", "the = a", f"{digits(4)}-{digits(2)}-{digits(2)}", f"abc{digits(3)}def", f"CC BY {digits(1)}.0"])

    out = []
    for _ in range(rows):
        text, found = "", []
        for _ in range(rng.randint(1, 14)):
            roll = rng.random()
            if roll < 0.76:
                text += word() + " "
            elif roll < 0.9:
                text += (plain() if rng.random() < 0.5 else no_secret()) + " "
            else:
                kind = rng.choice([*BASE, "secret", "secret", "secret", "told", "told"])
                if kind == "told" or kind == "secret" and rng.random() < 0.5:
                    name = rng.choice(["token", "key", "password", "api_key", "secret", "passwd", "pwd", "auth", "apikey", "access_key", "secret_key", "Password", "API_KEY"])
                    text += name + rng.choice([" = ", ": ", " : ", "= "] + [" "] * (kind == "secret")) + rng.choice(["", '"', "'"])
                v = value(kind)
                kind = "secret" if kind == "told" else kind
                found.append((kind, len(text), len(text) + len(v)))
                text += v + rng.choice([" ", " ", ". ", ", ", '" ', "### ", "!! ", "%%% "])
        out.append((text, found))
    return spark.createDataFrame(out, "text string, spans array<struct<kind: string, start: int, end: int>>")


def train(labelled: DataFrame) -> Field:
    """From at most ``TRAIN_ROWS`` rows of the labelled table, by hash of the text."""
    rows = labelled.orderBy(F.xxhash64("text"), "text").limit(TRAIN_ROWS).collect()
    lines = []
    for r in rows:
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        s, e, _ = C.spans(~C.IS_SPACE[data], np.array([0, len(data)]))
        if not len(s):
            continue
        y = np.zeros(len(s), np.int64)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for x in r["spans"] or []:
            y[(lead[s] < x["end"]) & (lead[e] > x["start"])] = LABELS.index(x["kind"])
        lines.append((shapes(data, s, e), y))
    return Field().fit(lines)


PLAIN_SHAPE = 0
SECRET = LABELS.index("secret")


def added_spans(field: Field, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, list[tuple[str, int, int]]]:
    """Spans of the field, as byte places in ``data``, and the text of each. A line of plain words
    only has the labels of any such line as long, so one is labelled for each length."""
    cut = np.union1d(offs, np.flatnonzero(data == 10) + 1)
    s, e, first = C.spans(~C.IS_SPACE[data], cut)
    shape = shapes(data, s, e)
    sizes = np.diff(first)
    odd = np.zeros(len(sizes), bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    odd[owner[shape != PLAIN_SHAPE]] = True
    label = np.zeros(len(s), np.int8)
    for n in np.unique(sizes[sizes > 0]).tolist():
        here = np.flatnonzero((sizes == n) & odd)
        calm = np.flatnonzero((sizes == n) & ~odd)
        if len(calm):
            got = field.viterbi(np.full((1, n), PLAIN_SHAPE))[0]
            if got.any():
                label[(first[calm][:, None] + np.arange(n)).ravel()] = np.tile(got, len(calm))
        most = max(1, (1 << 17) // n)
        for k in range(0, len(here), most):
            at = first[here[k:k + most]][:, None] + np.arange(n)
            label[at] = field.viterbi(shape[at])
    out, texts = [], []
    hit = np.flatnonzero(label)
    for run in np.split(hit, np.flatnonzero((np.diff(hit) > 1) | (np.diff(label[hit]) != 0) | (np.diff(owner[hit]) != 0) | (label[hit][1:] == SECRET)) + 1):
        if len(run):        # a secret is one word
            a, b = int(s[run[0]]), int(e[run[-1]])
            while a < b and _QUOTE[data[a]]:
                a += 1
            while a < b and _QUOTE[data[b - 1]]:
                b -= 1
            if a < b:
                out.append((LABELS[label[run[0]]], a, b))
                texts.append(int(np.searchsorted(offs, a, "right")) - 1)
    return np.array(texts, np.int64), out


def all_spans(field: Field, data: np.ndarray, offs: np.ndarray) -> list[tuple[str, list, list]]:
    """(text, base spans, added spans) of each text, in code points."""
    of, added = added_spans(field, data, offs)
    by_text: dict[int, list] = {}
    for i, x in zip(of.tolist(), added):
        by_text.setdefault(i, []).append(x)
    raw, out = data.tobytes(), []
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
        text = raw[a:b].decode("utf-8", "replace")
        base, more = base_spans(text), []
        lead = np.cumsum((data[a:b] & 0xC0) != 0x80) if i in by_text else None
        whole = lead is None or lead[-1] == len(text)        # else not UTF-8
        for kind, p, q in by_text.get(i, ()):
            if whole:
                s, t = int(lead[p - a]) - 1, int(lead[q - 1 - a])
            else:
                s = len(raw[a:p].decode("utf-8", "replace"))
                t = s + len(raw[p:q].decode("utf-8", "replace"))
            if not any(s < y and x < t for _, x, y in base):
                more.append((kind, s, t))
        out.append((text, base, more))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (order[x[0]], *x[1:])))


def _over_texts(docs: DataFrame, field: Field, schema: str, rows) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for b in batches:
            offs, data = C.buffers(b.column("text"))
            found = []
            for i, j in C.chunks(offs):
                found += all_spans(sent.value, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            yield rows(b, found)

    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Per text: doc_id, base counts, base_sha256, spans, added (number of added spans)."""
    def rows(b, found):
        kinds = [[k for k, _, _ in base] for _, base, _ in found]
        cols = [b.column("doc_id"), *(pa.array([ks.count(k) for ks in kinds], pa.int64()) for k in BASE),
                pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for _, base, _ in found], pa.string()),
                pa.array([joined(base + more) for _, base, more in found], pa.string()), pa.array([len(more) for _, _, more in found], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "added"])

    return _over_texts(C.byte_texts(docs), field, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, added long", rows)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span, or spans that touch, replaced by [kind] of the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """All rows and columns of ``docs`` with personal data masked; n_chars, where there is one,
    counts the new text. A null text stays null."""
    src = docs.select(F.struct(*[C.named(c) for c in docs.columns]).alias("carry"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def rows(b, found):
        return pa.RecordBatch.from_arrays([b.column("carry"), pa.array([masked(t, base + more) for t, base, more in found], pa.string())], names=["carry", "masked"])

    got = _over_texts(src, field, src.drop("text").withColumn("masked", F.lit("")).schema, rows)
    text = F.when(F.col("carry.text").isNotNull(), F.col("masked"))
    return got.select(*[text.alias(c) if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else C.named(c, "carry").alias(c) for c in docs.columns])
