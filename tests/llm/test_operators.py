"""Each operator against brute force or an exact round trip, with the awkward rows that its docstring defines."""

import base64
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from traveltiers.llm import (bpe_transducer, ftrl, host_rules, html_cut, jaccard_join, piece_counts, rans_ids, template_leaks, toxicity,
                             url_cascade, weak_labels)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HARD = [None, "", " ", "\n", "one", "a b c d", "é 😀 a😀 Ｆ", "x\x00y\x1cz\xa0w", "<s> <|endoftext|> x", "▁a▁ b", "  two  spaces \n\n lines ", "don't I'LL we'll 3,000.5%",
        "word " * 5000, " " * 700, "q" * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward texts, repeated rows and ids, null ids, and an extra column that clashes with internal and output names."""
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abdeimnorst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    texts = HARD + [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 160))) + "." for _ in range(60)]
    base = texts[-1].split()
    for k in range(6):
        near = list(base)
        near[(k * 7) % len(near)] = f"new{k}"
        texts.append(" ".join(near))
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or ""), "x", 0) for i, t in enumerate(texts)]
    rows += [rows[20], (20, texts[25], "en", None, 0, None, 1), (None, texts[30], None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, `__id` int").cache()


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def slow_base(text):
    ws = WORD.findall(text or "")
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(ws) < 400 else set(range(len(ws)))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_host_rules(docs):
    got = rows_of(host_rules.judge(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for r in docs.collect():
        b = slow_base(r["text"])
        want.append((r["doc_id"], *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert got == sorted(want, key=repr)


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}%%%" for i in range(60))
    rows = [(i, good if i % 10 else bad, "fine") for i in range(200)] + [(1000 + i, bad if i % 2 else good, "poor") for i in range(200)] + [(2000 + i, bad, "spam") for i in range(200)]
    out = host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    verdicts = {r["host_verdict"] for r in out.filter("doc_id >= 2000").collect()}
    assert verdicts == {"blocked"} and out.filter("doc_id >= 2000 and kept").count() == 0
    assert out.filter("doc_id < 1000 and kept").count() == 200  # only the base rules bind on a trusted host
    assert out.filter("doc_id between 1000 and 1999 and kept").count() == 100  # the soft ones too on a watched one


def slow_url(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(k), k, a) for a, k in url_cascade.RULES for h, _, p in [k.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"


def test_url_cascade(spark, monkeypatch):
    urls = [None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com/en", "http://example.com/en/",
            "http://a.b.www.example.com/en/z", "http://net/es/", "http://x.NET/fr/a://b/c", "http://notnet/es/", "http://xnet/es/", "a\n://m.net\n/es/", "http://.com/"]
    urls += [f"https://{s}{d}.{t}/{p}/{i}" for i, (s, d, t, p) in enumerate(itertools.product(["", "m.", "www."], ["example", "other", "net"], ["com", "net", "org"], ["en", "es", "fr", ""]))]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls + urls)], "page_id long, url string, host string")
    want = sorted(((i, *slow_url(u)) for i, u in enumerate(urls + urls)), key=repr)
    cols = ("page_id", "host", "path", "rule", "verdict")
    assert rows_of(url_cascade.judge(pages, url_cascade.rule_table(spark)), *cols) == want
    monkeypatch.setattr(url_cascade, "MAX_FILTER_BYTES", 0)  # filters beyond a literal's bound
    for size in (1, url_cascade.SHARD_KEYS):
        monkeypatch.setattr(url_cascade, "SHARD_KEYS", size)
        assert rows_of(url_cascade.judge(pages, url_cascade.rule_table(spark)), *cols) == want
    assert url_cascade.judge(pages.limit(0), url_cascade.rule_table(spark)).collect() == []
    none = url_cascade.judge(pages, url_cascade.rule_table(spark).limit(0)).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in none] == [(None, "allow")]


@pytest.mark.parametrize("bits", [2, 16])
def test_sharded_cascade_is_exact(spark, monkeypatch, bits):
    monkeypatch.setattr(url_cascade, "MAX_FILTER_BYTES", 40)  # the first levels in shards, the last as literals
    monkeypatch.setattr(url_cascade, "SHARD_KEYS", 100)
    monkeypatch.setattr(url_cascade, "BITS_PER_KEY", bits)
    listed = {i for i in range(3000) if i % 5 == 0}
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    c = url_cascade.Cascade(universe, universe.filter(F.substring("key", 2, 9).cast("int") % 5 == 0))
    got = c.mark(universe.unionByName(universe), "key", "hit").filter("hit").collect()
    assert sorted(int(r["key"][1:]) for r in got) == sorted([*listed, *listed]) and c.levels[0].shards == 6 and not c.levels[-1].shards


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "BITS_PER_KEY", 2)  # small filters, so many levels
    listed = {i for i in range(3000) if i % 5 == 0}
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    c = url_cascade.Cascade(universe, universe.filter(F.substring("key", 2, 9).cast("int") % 5 == 0))
    got = {int(r["key"][1:]) for r in universe.filter(c.listed(F.col("key"))).collect()}
    assert got == listed and len(c.levels) > 2


def slow_cut(scores, ties):
    def cost(x):
        return sum(max(0, -s) if y else max(0, s) for s, y in zip(scores, x)) + sum(w for a, b, w in ties if x[a] != x[b])
    return min(map(cost, itertools.product([False, True], repeat=len(scores)))), cost


def test_min_cut_is_least():
    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randint(1, 8)
        scores = [rnd.randint(-1500, 1500) for _ in range(n)]
        ties = [(i - 1, i, rnd.randint(1, 900)) for i in range(1, n)] + [(a, b, rnd.randint(1, 700)) for a in range(n) for b in range(a + 2, n) if rnd.random() < 0.3]
        least, cost = slow_cut(scores, ties)
        assert cost(html_cut.cut_labels(scores, ties)) == least


def test_html(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies on this site.</p></div><main><article><h1>Big &amp; small</h1>
    <p><b>First  line<br>goes on.<p>Second&nbsp;one, caf&eacute;.</p><div class="ad">Buy now.</div><aside><p>Related things.</p></aside><p>Third one here.</p></article>
    <form><p>Your mail</p><input></form><section id="comments"><p>I liked this article very much, thanks a lot for writing it.</p></section></main><footer><p>&copy; us</p></footer></body></html>"""
    want = "Big & small\n\nFirst line goes on.\n\nSecond one, café.\n\nThird one here."
    rows = [(1, "u", page, 1), (2, None, None, 1), (3, "u", "", 1), (1, "u", page, 1), (4, "u", "<nav>x</nav>", 1), (5, "u", "<p>" + "deep " * 40 + "<div>" * 2000, 1)]
    out = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_cut.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()}
    assert out[1] == (want, len(want)) and out[2] == out[3] == out[4] == ("", 0) and out[5][0].startswith("deep deep")


@pytest.mark.parametrize("before, after", [
    ("<body class='has-sidebar'><article>", "</article>"), ("<body class='sidebar' id='social'><main>", "</main>"), ("<article class='post tag-news related-1'>", "</article>"),
    ("<article class='social'>", "</article>"), ("<div class='with-sidebar'>", "</div>"), ("<div class='sidebar-left'><main>", "</main></div>"), ("<div id='modal'>", "</div>"),
    ("<form id='aspnetForm'><article>", "</article></form>"), ("<form><div>", "</div></form>"), ("<div class='post related-1'>", "</div>")])
def test_html_names_of_whole_pages(before, after):
    """Names and forms around the whole page cost nothing; those of its parts still do."""
    text = " ".join(f"word{i}" for i in range(50)) + "."
    noise = "<div class='related'><p>Other things to read here.</p></div><form><p>Your mail, please.</p></form>"
    assert html_cut.main_text(f"<html>{before}<p>{text}</p>{after}</html>") == text
    assert html_cut.main_text(f"<html>{before}<p>{text}</p>{noise}{after}</html>") == text


def test_html_comments_stay_out():
    """Comments go also where they hold most of the text, with an article of their own each."""
    text, said = " ".join(f"word{i}" for i in range(50)) + ".", "I liked this very much, thanks a lot for writing it. " * 9
    comments = f"<section id='comments'><article class='comment'><p>{said}</p></article></section>"
    assert html_cut.main_text(f"<body><article><p>{text}</p></article>{comments}</body>") == text
    assert html_cut.main_text(f"<body><article><p>{text}</p><article class='comment'><p>{said}</p></article></article></body>") == text


def test_html_deep_pages():
    """Depth costs nothing: text at each of 20,000 open elements, closed ones that never opened."""
    start = time.perf_counter()
    for page in ("<div>some text here." * 20_000, "<p>some text here " * 20_000, "<div>" * 20_000 + "</p>x " * 20_000):
        html_cut.main_text(page)
    assert time.perf_counter() - start < 20
    text = " ".join(f"word{i}" for i in range(50)) + "."
    assert html_cut.main_text("<div>" * 20_000 + f"<article><p>{text}</p></article>" + "</div>" * 20_000) == text


def test_html_marks_around_deep_blocks():
    """Elements' own sums against the plain form over each block's whole path."""
    rnd = random.Random(8)
    tags, names = "div article main nav footer form section li p".split(), ["", " class=sidebar", " class='post content'", " id=comments", " class=has-sidebar"]
    for _ in range(300):
        page = "".join(rnd.choice([f"<{rnd.choice(tags)}{rnd.choice(names)}>", f"</{rnd.choice(tags)}>", "word " * rnd.choice([1, 9, 40])]) for _ in range(40))
        parser = html_cut.Parser()
        parser.feed(page), parser.close(), parser.flush()
        wide = html_cut.page_wide(parser.blocks, parser.elements)
        html_cut.weigh(parser.elements, wide)
        paths = []
        for b in parser.blocks:
            path, e = [], b.at
            while e:
                path.insert(0, e)
                e = e.parent
            paths.append(path)
            around = [0, *(x.wide if x in wide else x.mark for x in path)]
            assert not path or (b.at.most, b.at.least) == (max(around), min(around))
        for a, b in zip(paths, paths[1:]):
            assert html_cut.steps(a[-1] if a else None, b[-1] if b else None) == len(set(a) ^ set(b))
        live = [(p, b) for p, b in zip(paths, parser.blocks) if not any(x.mark <= html_cut.NEVER_COST for x in p)]
        held = lambda x: sum(len(b.text) for p, b in live if x in p)
        firsts = {t: [p[:[x.tag for x in p].index(t)] for p, _ in live if t in [x.tag for x in p] and not {"nav", "aside", "footer"} & {x.tag for x in p}] for t in ("main", "article")}
        around, total = firsts["main"] or firsts["article"], sum(len(b.text) for _, b in live)
        asked = [x for x in parser.elements if x.mark < x.wide]
        want = {x for x in asked if (all(x in p for p in around) and 2 * held(x) > total if around else 5 * held(x) >= 4 * total)}
        assert wide == want


def test_piece_counts(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(sp.encode(r["text"] or ""))) for r in docs.collect()), key=repr)
    assert rows_of(piece_counts.count_tokens(docs, P.path("piece_bpe_32k.model")), "doc_id", "n_bytes", "n_tokens") == want


def test_bpe(docs):
    import tiktoken

    ranks = bpe_transducer.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    out = bpe_transducer.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert rows_of(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_long_runs():
    """One pre-token of a million letters costs in proportion; a shorter one equals the library."""
    import tiktoken

    file = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
    own = bpe_transducer.Codec(file, P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_transducer.read_ranks(file), special_tokens={})
    run = "".join(random.Random(2).choices("etaoinshrdlu", k=1_000_000))
    assert own.encode(run[:30_000]) == enc.encode_ordinary(run[:30_000])
    start = time.perf_counter()
    ids = own.encode(run)
    assert time.perf_counter() - start < 40 and "".join(x for _, x in own.decode(ids)) == run


def test_bpe_forgets(monkeypatch):
    """Small bounds change nothing."""
    ranks = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
    free = bpe_transducer.Codec(ranks, P.PATTERN)
    texts = ["".join(random.Random(i).choice("etaoin shrdlu.é") for _ in range(400)) for i in range(30)] + ["abc" * 500]
    want = [free.encode(t) for t in texts]
    for name in ("MEMO_WORDS", "MEMO_STEPS", "MEMO_PAIRS"):
        monkeypatch.setattr(bpe_transducer, name, 7)
    tight = bpe_transducer.Codec(ranks, P.PATTERN)
    assert [tight.encode(t) for t in texts] == want
    assert ["".join(x for _, x in tight.decode(i)) for i in want] == texts


def test_bpe_ascii_split():
    """ASCII texts are split by a pattern without Unicode classes, into the same pieces."""
    own = bpe_transducer.Codec(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), P.PATTERN)
    rnd, every = random.Random(3), [chr(i) for i in range(128)]
    assert own.split_ascii is not own.split
    for k in range(20_000):
        text = "".join(rnd.choices(every if k % 2 else "a1 '\n\tslvredtm.\x1c\x0b", k=rnd.randint(1, 12)))
        assert own.split_ascii.findall(text) == own.split.findall(text), text
    assert own.encode("we're 7 \n x") == [i for t in own.split.findall("we're 7 \n x") for i in own.machine.merged(t.encode())]
    other = bpe_transducer.Codec(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), r"\p{L}+|\P{L}")
    assert other.split_ascii is other.split


def test_bpe_start_is_no_neighbour():
    """Whether token 0 may stand at the start says nothing of two of them in a row."""
    machine = bpe_transducer.Transducer({bytes([i]): i for i in range(256)} | {b"\0\0": 256})
    assert machine.follows(-1, 0) and not machine.follows(0, 0)
    assert machine.encode(b"\0\0\0") == tuple(machine.merged(b"\0\0\0"))


def test_rans_files(docs, spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(rans_ids, "BLOCK_IDS", 2000)
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = [(r["doc_id"], r["text"], tok.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]
    rans_ids.write_ids(docs, P.path("word_bpe_49k.json"), f"{tmp_path}/f")
    out = sorted(rans_ids.read_ids(spark, f"{tmp_path}/f", with_ids=True).collect(), key=lambda r: r["start"])
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in out if r["doc_id"] is not None) == sorted((k, tuple(x)) for k, _, x in ids if k is not None)
    start = 0
    for r in out:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    keys = [r["doc_id"] for r in out if r["doc_id"] is not None]
    assert keys == sorted(keys)


def test_rans_case_of_added_tokens():
    """An added token's string in another case is ordinary text, also where its run is shared or stands within a word."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    own = rans_ids.Ids(open(path, encoding="utf-8").read())
    texts = ["<|ENDOFTEXT|>", "<|StartOfText|>", "A <|EndOfText|> b<|STARTOFTEXT|>C, Word, word", "<|endoftext|>", "x <|startoftext|> <|ENDOFTEXT|>", "<|ENDOFTEXT|>.", "Word, WORD. word"]
    for t, ids in zip(texts, own.of(texts)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids + [2], t


def test_rans_looks_up_distinct_runs(monkeypatch):
    """A batch looks up each distinct run once, whatever white space is between; ids are the library's, with few runs gathered at once too."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok, asked = Tokenizer.from_file(path), []

    class Counted(rans_ids.Codes):
        def __getitem__(self, run):
            asked.append(run)
            return super().__getitem__(run)

    own = rans_ids.Ids(open(path, encoding="utf-8").read())
    own.codes = Counted(own.codes)
    texts = ["the cat the cat", "the  cat,\tThe cat.", None, "", " \n ", "\x0bCAT\x0c", "été Été, ÉTÉ. straße x\x1cy x\u3000y a\x85b", ", . ,. a,. 4, don't", "ÀÖŸ ĀɏſƏ Ωmega 中文 e\u0301"]
    want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert [x.tolist() for x in own.of(texts)] == want
    assert len(asked) == len(set(asked))
    monkeypatch.setattr(rans_ids, "HOLD_RUNS", 2)
    assert [x.tolist() for x in rans_ids.Ids(open(path, encoding="utf-8").read()).of(texts)] == want


def test_rans_block_parts():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 1023, 1024, 1025, 200_000):
        ids = np.minimum(rnd.zipf(1.3, n), 40_000)
        coder = rans_ids.Coder(np.bincount(ids, minlength=5))
        block = coder.encode(ids)
        assert (coder.decode(block) == ids).all()
        for k in range(1 + len(block["mark_at"])):
            at = [0, *block["mark_at"], n]
            assert (coder.decode_part(block, k) == ids[at[k]:at[k + 1]]).all()
    with pytest.raises(ValueError):
        coder.decode(block | {"checksum": 1})


def test_toxicity(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["sun", "moon", "tree", "road", "fish"]) + str(rnd.randint(0, 99)) for _ in range(40)) + (" scum" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(900)]
    docs = spark.createDataFrame(rows + [(5000, None, 0), (5001, "", 0)], "doc_id long, text string, y int")
    labels = docs.select("doc_id", F.col("y").alias("toxic"))
    out = toxicity.score(docs, toxicity.fit(docs, labels)).join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["y"] for r in held) > 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_weak_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    right = weak_labels.classify(d).select("doc_id", "kept").join(labels, "doc_id").select((F.col("kept") == (F.col("quality") == 1)).alias("ok"), "quality").groupBy("quality").agg(F.avg(F.col("ok").cast("int")).alias("a")).collect()
    assert len(right) == 2 and all(r["a"] > 0.95 for r in right)


def slow_components(rows):
    def grams(t):
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
    sets = [(i, grams(t)) for i, t in rows]
    comp = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and sets[a][0] is not None and sets[b][0] is not None and 100 * len(x & y) >= 80 * len(x | y):
            old, new = comp[b], comp[a]
            comp = [new if c == old else c for c in comp]
    return sorted(((sets[i][0], len(sets[i][1]), None if sets[i][0] is None else min(sets[j][0] for j in range(len(sets)) if comp[j] == comp[i] and sets[j][0] is not None)) for i in range(len(sets))), key=repr)


def test_jaccard(docs, spark, monkeypatch):
    want = slow_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    cols = ("doc_id", "n_shingles", "component_id")
    assert rows_of(jaccard_join.join(docs), *cols) == want
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 2)  # lists dealt over salts
    assert rows_of(jaccard_join.join(docs), *cols) == want


def test_jaccard_gray_zone(spark):
    """A group around the limit, where most pairs don't link, and a passage that many short documents share."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for k in range(60):
        t = list(base)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(80)] = f"z{rnd.randrange(40)}"
        texts.append(" ".join(t))
    texts += [" ".join(base[:30] + [f"q{k}x{i}" for i in range(rnd.randint(0, 12))]) for k in range(60)]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in range(1, 30)]
    rows = list(enumerate(texts))
    assert rows_of(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id") == slow_components(rows)


def test_jaccard_pairs_of_a_near_group(spark, monkeypatch):
    """A large group of near copies, most of which link with few: its pairs are nearly all settled before all classes of a list meet."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(240):
        t = list(base)
        for i in range((1, 2, 4)[k % 3]):
            t[rnd.randrange(150)] = f"z{k}x{i}"
        texts.append(" ".join(t))
    rows = list(enumerate(texts))
    met, cut = [], jaccard_join.cut

    def counted(df):
        out = cut(df)
        if "ac" in out.columns:
            met.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "cut", counted)
    assert rows_of(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id") == slow_components(rows)
    assert len(met) == 1 and met[0] < len(rows)


def test_jaccard_sketches_refute_no_link(spark):
    """Sets just inside and outside the limit, small and far larger than a sketch: no linked pair is refuted, and unlike pairs of usual size are."""
    rnd = np.random.default_rng(4)
    sets, linked = [], []
    for n in (5, 40, 500, 5000):
        for gone in (0, n // 20, n // 9, n // 8, n // 4):
            x = np.unique(rnd.integers(0, 1 << 48, n, dtype=np.uint64))
            y = np.unique(np.concatenate([x[gone:], rnd.integers(0, 1 << 48, gone, dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            sets.append((x, y))
            linked.append(100 * both >= 80 * (len(x) + len(y) - both))
    names = [f"a{i}" for i in range(jaccard_join.SKETCH)], [f"b{i}" for i in range(jaccard_join.SKETCH)]
    rows = [(i, len(x), len(y), *jaccard_join.sketch(x).tolist(), *jaccard_join.sketch(y).tolist()) for i, (x, y) in enumerate(sets)]
    kinds = ", ".join(["i int, an int, bn int", *(f"{c} long" for c in names[0] + names[1])])
    left = {r["i"] for r in spark.createDataFrame(rows, kinds).filter(jaccard_join.near("an", "bn", *names)).collect()}
    assert any(linked) and {i for i, ok in enumerate(linked) if ok} <= left
    assert 14 not in left  # 500 shingles, a quarter exchanged


def slow_groups(texts):
    """Rows by component (rows without words by themselves), ids left aside."""
    def grams(t):
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
    sets, comp = [grams(t) for t in texts], list(range(len(texts)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    return [[i for i, c in enumerate(comp) if c == x] for x in sorted(set(comp))]


def check_kept(docs):
    """Of each component exactly one row stays, one with its least id; null ids come last."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    left = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_documents(docs).collect()]
    groups = slow_groups([t for _, t in rows])
    assert len(left) == len(groups)
    for g in groups:
        own = {rows[i] for i in g}
        least = min((k for k, _ in own if k is not None), default=None)
        assert [k for k, t in left if (k, t) in own] == [least]


def test_jaccard_keeps_one_row_a_group(docs):
    check_kept(docs)


def test_jaccard_keeps_texts_of_one_id(spark):
    """Texts of one id, or of none, that link with nothing stay; copies go, whatever their id."""
    texts = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(30)]
    rows = [(7, t) for t in texts[:10]] + [(None, t) for t in texts[10:20]] * 3 + [(3, texts[20]), (5, texts[20] + " x"), (5, texts[21]), (9, texts[21]), (9, texts[21])]
    rows += [(None, texts[22]), (None, texts[22] + " y"), (None, texts[23]), (4, texts[23])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_kept(docs)
    assert jaccard_join.keep_documents(docs).count() == 24


def test_leaks(spark):
    item = "In 2019 the farmer Smith sold 12 kg of rice to the miller and then walked 30 miles over the old hill road."
    other = item.replace("Smith", "Jones").replace("12", "48").replace("2019", "1876").replace("30", "77")
    torn = item.replace("12 kg", "12 kg of corn and barley with some beans, never any")
    fill = "lorem stone water grass cloud river metal paper " * 4
    rows = [(1, fill + item + " " + fill, 0), (2, fill + other + fill, 0), (3, fill, 0), (4, None, 0), (5, "", 0), (6, item.upper(), 0), (None, item, 0), (8, torn[:60] + fill, 0), (1, fill + item + " " + fill, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["copied"]) for r in template_leaks.find(docs, bench).collect()}
    assert set(got) == {1, 2, 6, None} and got[1] == (7, True) and got[2] == (7, False)
    left = template_leaks.keep_documents(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 8]
    assert template_leaks.find(docs, bench.limit(0)).count() == 0


def test_leaks_of_other_case_and_excerpts(spark):
    """Copies in title case, without case or punctuation, and a run of 13 words are found; 12 words, or a run with other numbers, aren't."""
    item = ("When Anna met the baker in Rome, Peter told Maria that 12 wagons of flour, sent by Carlo from Milan, had been lost near the bridge of Verona; "
            "so Anna wrote to Luca, and Luca asked Paolo whether the miller knew the road that leads over the hills.")
    words = item.split()
    bare = re.sub(r"[^\w ]", "", item)
    fill = "lorem stone water grass cloud river metal paper " * 4
    rows = list(enumerate([item, item.title(), item.lower(), item.upper(), bare, bare.title(), fill + " ".join(words[4:17]) + " " + fill, fill + " ".join(words[3:16]).title() + " " + fill,
                           fill + " ".join(words[4:16]) + " " + fill, fill + " ".join(words[4:17]).replace("12", "77") + " " + fill, fill, None, ""]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = template_leaks.find(docs, bench).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(8)) and all(r["copied"] for r in got)
    assert sorted(r["doc_id"] for r in template_leaks.keep_documents(docs, bench).collect()) == [8, 9, 10, 11, 12]


@pytest.mark.parametrize("name", ["host", "weak", "jaccard", "leaks", "toxic", "pieces", "bpe", "rans"])
def test_empty_tables(spark, docs, name, tmp_path):
    none = docs.limit(0)
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    if name == "rans":
        rans_ids.write_ids(none, P.path("word_bpe_49k.json"), f"{tmp_path}/f")
        out = rans_ids.read_ids(spark, f"{tmp_path}/f")
    else:
        out = {"host": lambda: host_rules.judge(none), "weak": lambda: weak_labels.classify(none), "jaccard": lambda: jaccard_join.join(none),
               "leaks": lambda: template_leaks.find(none, bench), "toxic": lambda: toxicity.score(none, {}),
               "pieces": lambda: piece_counts.count_tokens(none, P.path("piece_bpe_32k.model")),
               "bpe": lambda: bpe_transducer.encode_decode(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)}[name]()
    assert out.count() == 0


def test_stages_keep_columns(docs):
    for keep in (host_rules.keep_documents, weak_labels.keep_documents, jaccard_join.keep_documents):
        out = keep(docs)
        assert out.columns == docs.columns and out.count() <= docs.count()
