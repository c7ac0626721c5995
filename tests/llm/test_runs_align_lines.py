"""Operators 11 to 13 against brute force, with the awkward rows that their docstrings define."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers as P
import pytest

from traveltiers.llm import line_dedup, period_runs, queries, token_align
from traveltiers.llm.common import words

HARD = [None, "", " ", "\n", "one", "é 😀 a😀 Ｆ", "x\x00y\x1cz\xa0w", "<s> <|endoftext|> <0x41> x", "▁a▁ b", "  two  spaces \n\n lines ", "end ", "a\n", "\n a", "a \tb\r\nc",
        "don't I'LL we'll 3,000.5%", "word " * 5000, " " * 700, "q" * 3000, "a b c " * 30 + "d e f " * 30, "x　 y\x85 z"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward texts, copies, repeated rows and ids, null ids, and extra columns with clashing names."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abdeimnorst") for _ in range(rnd.randint(2, 7))) for _ in range(200)]
    lines = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 12))) for _ in range(40)]
    texts = list(HARD)
    for i in range(60):
        own = [rnd.choice(lines) if rnd.random() < 0.4 else " ".join(rnd.choice(vocab) for _ in range(9)) for _ in range(rnd.randint(1, 12))]
        texts.append("\n".join(x.upper() + " \t" if rnd.random() < 0.2 else x for x in own))
    texts += [texts[30]] * 12
    rows = [(i, t, "en", "x", 0, 1) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (20, texts[45], "en", None, 0, 1), (None, texts[33], None, None, None, None), (None, texts[33], None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, h1 int, runs int").cache()


# ---------------------------------------------------------------- operator 11

def slow_runs(w, min_length=24, min_exponent=3):
    """Every period of every maximal stretch, by definition."""
    found = {}
    n = len(w)
    for q in range(1, n // min_exponent + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(min_length, min_exponent * q):
                found[start, length] = min(q, found.get((start, length), q))
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_words(rnd):
    """Words in which powers of short words stand side by side, nested and broken."""
    out = []
    for _ in range(rnd.randint(1, 5)):
        unit = [rnd.choice("ab") if rnd.random() < 0.7 else rnd.choice("cdefgh") for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 13, 16, 17, 20, 31, 32, 33, 47]))]
        if rnd.random() < 0.4:
            unit = unit[:3] * rnd.randint(3, 12) + unit
        part = unit * rnd.randint(1, 6)
        out += part[:len(part) - rnd.randint(0, len(unit) - 1)]
        if rnd.random() < 0.3:
            out += [rnd.choice("abc") for _ in range(rnd.randint(0, 9))]
        if out and rnd.random() < 0.3:
            out[rnd.randrange(len(out))] = "z"
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [periodic_words(rnd) for _ in range(250)]
    assert list(period_runs.Finder().of(texts)) == [slow_runs(w) for w in texts]
    assert list(period_runs.Finder(40, 4).of(texts)) == [slow_runs(w, 40, 4) for w in texts]


def test_runs_of_many_equal_words_are_linear():
    w = ["a"] * 400_000 + ["b"] + ["c", "d"] * 100_000
    assert list(period_runs.Finder().of([w])) == [[(0, 400_000, 1), (400_001, 200_000, 2)]]


def test_runs_reject_too_short_bounds():
    for bad in ((10, 3), (24, 2)):
        with pytest.raises(ValueError):
            period_runs.Finder(*bad)


def digest(k, w):
    runs = slow_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (k, len(runs), *top, top[0] is not None and 1000 * top[1] // top[2] or None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def by_contract(k, text):
    w = words(text)
    h = zlib.crc32(str(k).encode()) if k is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def through(docs, name, monkeypatch, module):
    monkeypatch.setattr(module, "table", lambda *_: docs)
    return sorted((tuple(r) for r in queries.QUERIES[name](docs.sparkSession, "").collect()), key=repr)


def test_runs_query(docs, monkeypatch):
    got = through(docs, "op11_period_runs", monkeypatch, period_runs)
    assert got == sorted((digest(r["doc_id"], by_contract(r["doc_id"], r["text"])) for r in docs.collect()), key=repr)
    assert sum(r[1] for r in got) >= 5


# ---------------------------------------------------------------- operator 12

@pytest.fixture(scope="module")
def aligner():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(P.path("piece_bpe_32k.model"), "rb") as g:
        return token_align.Aligner(f.read(), g.read())


def slow_align(al, text):
    """Groups by common ends of the libraries' tokens of the whole text."""
    if not text:
        return []
    data = (" " + text).encode()
    a, b = al.a.encode(" " + text, add_special_tokens=False).ids, al.b.encode(text)
    pieces = [al.b.id_to_piece(i) for i in b]
    bb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and al.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    letters = token_align.byte_letters()
    ab = [bytes(letters[c] for c in al.a.id_to_token(i)) for i in a]
    if b"".join(ab) != data or b"".join(bb) != data:
        return []
    ends = [[sum(map(len, x[:i + 1])) for i in range(len(x))] for x in (ab, bb)] if len(data) < 4000 else None
    if ends is None:
        ends = []
        for x in (ab, bb):
            at, own = 0, []
            for t in x:
                at += len(t)
                own.append(at)
            ends.append(own)
    both = sorted(set(ends[0]) & set(ends[1]))
    out, fa, fb = [], 0, 0
    for e in both:
        i, j = ends[0].index(e, fa) + 1, ends[1].index(e, fb) + 1
        out.append((a[fa:i], b[fb:j]))
        fa, fb = i, j
    return out


def test_segments_align_like_whole_texts(aligner):
    rnd = random.Random(3)
    alphabet = [" ", " ", "  ", "\n", "\t", "\r", "\xa0", "　", "▁", "a", "the", "ing", "é", "ß", "漢字", "😀", "'s", "'LL", "12", "3.5", ",", "--", "<s>", "<0x41>", "<|endoftext|>", "\x1c", "\x00", "‍", "é"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14))) for _ in range(1500)] + [t for t in HARD if t]
    for t, (said, four, pairs, links) in zip(texts, aligner.of(texts)):
        want = slow_align(aligner, t)
        assert said == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want), repr(t)
        count = Counter(i * aligner.width + j for x, y in want for i in x for j in y)
        assert dict(zip(pairs.tolist(), links.tolist())) == count
        assert four == [sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), sum(count.values())]


@pytest.mark.parametrize("heavy", [0, 50, token_align.HEAVY])
def test_align_query(docs, aligner, monkeypatch, heavy):
    monkeypatch.setattr(token_align.align, "__defaults__", (heavy, *token_align.align.__defaults__[1:]))
    got = through(docs, "op12_token_align", monkeypatch, token_align)
    groups = [(r["doc_id"], slow_align(aligner, r["text"])) for r in docs.collect()]
    links = [Counter((i, j) for x, y in g for i in x for j in y) for _, g in groups]
    count = Counter(p for own in links for p in own)
    top = {}
    for (i, _), n in count.items():
        top[i] = max(n, top.get(i, 0))
    want = [(k, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()), sum(n for p, n in own.items() if count[p] == top[p[0]]),
             sum(n * count[p] for p, n in own.items()), sha(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)) if g else "")
            for (k, g), own in zip(groups, links)]
    assert got == sorted(want, key=repr)


# ---------------------------------------------------------------- operator 13

def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def slow_lines(rows, min_docs):
    where = {}
    for k, t in rows:
        for x in (t or "").split("\n"):
            if key_of(x):
                where.setdefault(key_of(x), set()).add(k)
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key_of(x) or len(where[key_of(x)]) < min_docs]
        out.append((k, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def test_lines_query(docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = through(docs, "op13_line_dedup", monkeypatch, line_dedup)
    assert got == slow_lines(rows, 10)
    assert sum(r[2] for r in got) > 50


def test_keep_bitmaps_hold_runs_of_kept_lines(spark):
    rows = [(i, f"a{i}\nshared\nb{i}\nc{i}\n SHARED\t\n") for i in range(10)] + [(10, "shared")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc"]: ([tuple(x) for x in r["keep"]], r["n"], r["n_dropped"]) for r in line_dedup.keep_bitmaps(docs).collect()}
    assert got == {i: ([(0, 1), (2, 2), (5, 1)], 6, 2) for i in range(10)} | {10: ([], 1, 1)}
    first = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=2, keep_first=True))
    kept = {r["doc"]: r["kept"] for r in first.collect()}
    assert kept == {0: "a0\nshared\nb0\nc0\n"} | {i: f"a{i}\nb{i}\nc{i}\n" for i in range(1, 10)} | {10: ""}


def test_line_dedup_uses_no_python(docs):
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).explain()
    assert not re.search("Python|Pandas|Arrow", out.getvalue())


@pytest.mark.parametrize("name,module", [("op11_period_runs", period_runs), ("op12_token_align", token_align), ("op13_line_dedup", line_dedup)])
def test_empty_table(docs, monkeypatch, name, module):
    assert through(docs.limit(0), name, monkeypatch, module) == []
