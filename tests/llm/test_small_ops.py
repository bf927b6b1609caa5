"""Operators against plain Python on the smallest tables, and on odd rows."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import xxhash
from corpus_fixtures import SMALL, docs, make  # noqa: F401
from tokenizers import Tokenizer

from tidemark.llm import contamination, extraction, language, neighbours, packing, secrets, simhash, toxicity
from tidemark.llm.batches import by_bytes, utf8
from tidemark.llm.queries import QUERIES, SQL, tokenizer_paths
from tidemark.llm.tokens import Encoder

LONG = "lorem " * 300_000
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "a b c"), (5, "a b c"), (6, "a b c"), (None, "x y z"), (7, "naïve café 12 日本 　 <|endoftext|>")]


def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


# -- language


def test_language_accuracy(spark):
    got = QUERIES["op3_language"](spark, "/root/testdata/sf0.01").collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(true) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang_pred"] == true[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(make, docs):
    model = language.fit(docs)
    got = language.identify(make(*ODD), model).collect()
    assert len(got) == len(ODD)
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (1, 2, 3))
    assert all(r["lang_pred"] != "und" for r in got if r["doc_id"] in (4, 5, 6))
    empty = language.fit(make().where("false"))
    assert {r["lang_pred"] for r in language.identify(make(*ODD), empty).collect()} == {"und"}
    assert language.identify(make(), model).count() == 0


def test_language_matches_direct_sums(docs):
    model = language.fit(docs)
    text = docs.where("text is not null").first()["text"]
    bucket, _, _ = language.grams([text])
    by_hand = [model.prior[i] + sum(float(model.logp[i][b]) for b in bucket) for i in range(len(model.langs))]
    lang, sure = language.score(model, ["", text, text])
    assert lang[1] == lang[2] == model.langs[int(np.argmax(by_hand))]
    assert sure[1] == pytest.approx(1 / np.exp(np.array(by_hand) - max(by_hand)).sum(), rel=1e-6)


# -- decontamination


def test_contamination_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = sorted(con.execute(SQL["op2_decontaminate"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op2_decontaminate"](spark, "/root/testdata/sf0.01").collect())
    assert got == want and len(got) > 10


def test_contamination_odd_rows(spark, make):
    item = " ".join(f"w{i}" for i in range(40))
    near = " ".join(f"w{i}" if i != 20 else "changed" for i in range(40))
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "a b c"), (None, item), (5, "Q " * 3000)], "item_id long, text string")
    rows = [*ODD, (20, LONG + item.upper() + " " + LONG), (21, near), (22, "q " * 100), (23, item[:60])]
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in contamination.find(make(*rows), items).collect()}
    assert got[(20, 1)] == 1.0 and got[(5, 4)] == got[(6, 4)] == 1.0 and got[(21, 1)] == pytest.approx(31 / 36)
    assert got[(22, 5)] == 1.0 and set(got) == {(20, 1), (21, 1), (5, 4), (6, 4), (22, 5)}
    assert contamination.find(make(), items).count() == 0
    assert contamination.find(make(*rows), items.where("false")).count() == 0


def test_contamination_never_misses(make, spark):
    rng = random.Random(4)
    items, rows = [], []
    for i in range(12):
        w = [f"t{rng.randrange(10**6)}" for _ in range(rng.choice([6, 30, 200, 900]))]
        items.append((i, " ".join(w)))
        for k in range(4):
            v = list(w)
            for _ in range(rng.randrange(1 + len(w) // 20)):
                v[rng.randrange(len(v))] = "edit"
            rows.append((100 * i + k, " ".join(["pad"] * rng.randrange(50) + v + ["pad"] * 50)))
    want = set()
    for d, t in rows:
        own = set(contamination.shingles(t.encode()))
        for i, x in items:
            s = set(contamination.shingles(x.encode()))
            if len(s & own) >= 0.8 * len(s) - 1e-9:
                want.add((d, i))
    got = {(r[0], r[1]) for r in contamination.find(make(*rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 20


# -- SimHash


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash_brute(docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    prints = {d: slow_fingerprint(t) for d, t in texts(docs).items()}
    parts = slow_components(prints)
    assert got == {d: (f"{f:016x}", parts[d]) for d, f in prints.items()}


def test_simhash_odd_rows(make):
    got = [tuple(r) for r in simhash.near_duplicates(make(*ODD)).collect()]
    assert len(got) == len(ODD) - 1
    by = {d: (f, c) for d, f, c in got}
    assert by[1] == by[2] == by[3] == ("0" * 16, 1) and by[5] == by[6] and by[5][1] == 5
    assert simhash.near_duplicates(make()).count() == 0


def test_simhash_big_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = random.Random(1)
    base = rng.getrandbits(64)
    f = {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)} | {rng.getrandbits(64) for _ in range(300)}
    rows = [(simhash.signed(x), i) for i, x in enumerate(sorted(f))]
    prints = spark.createDataFrame(rows, "f long, d long")
    got = {r["f"] % 2**64: r["c"] for r in simhash.components(prints).collect()}
    ids = {i: x % 2**64 for x, i in rows}
    want = slow_components(ids)
    assert {ids[i]: c for i, c in want.items() if list(want.values()).count(c) > 1} == got


# -- toxicity


def test_toxicity_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    true = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(true[d], r["predicted"]) for d, r in got.items() if d in true and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for d, r in got.items())
    caught = [p for t, p in held if t == 1]
    clean = [p for t, p in held if t == 0]
    assert np.mean(caught) > 0.75 and np.mean(clean) < 0.02


def test_toxicity_sample_drops_equal_texts_only(spark):
    texts = ["a common beginning one", "a common beginning two", "a common beginning one", "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in (2, 4))) for i in range(5)], "doc_id long, toxic int")
    got = sorted((r["text"], r["toxic"]) for r in toxicity.sample(docs, labels, 100).collect())
    assert got == sorted({(t, int(i in (2, 4))) for i, t in enumerate(texts)})


def test_toxicity_fit_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    one, many = (toxicity.fit(docs.repartition(n), labels) for n in (1, 7))
    assert one == many and one.weights


def test_toxicity_folding_and_exceptions():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " clown ": 4.0, " vequ": 3.0}, (" clown fish ",))
    a = lexicon.automaton()
    weight = lambda t: sum(w for _, _, w in toxicity.hits(a, toxicity.fold(t)))
    assert weight("An IDIOT, a ｉdiоt and 1d10t") == 15.0
    assert weight("a clown fish, a Clown") == 4.0 and weight("vequée") == 3.0 and weight("preidiot idiotic") == 0.0


def test_toxicity_odd_rows(spark, make):
    lexicon = toxicity.Lexicon({" lorem ": 5.0})
    got = toxicity.score(make(*ODD), lexicon).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert next(r for r in got if r["doc_id"] == 4)["predicted"] == 1
    none = toxicity.fit(make(), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(make(*ODD), none).count() == len(ODD)


# -- extraction


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><a href=/>Home</a></nav><div class="ad">Buy &amp; save</div><main><article><h1>A  title</h1><p>First &lt;b&gt; para<b>graph</b>.
<p>Second&nbsp;one</p><ul><li>x<li>y</ul><script>var t="</p>"</script></article></main>
<aside><p>Side bar words</p></aside><form><label>Name</label></form><div id="comments"><p>I agree with every word of this long comment, dear author.</p></div>
<footer>&copy; us</footer></body></html>"""


def test_extraction_page():
    assert extraction.main_text(PAGE) == "A title\nFirst <b> paragraph.\nSecond one\nx\ny"


def test_extraction_articles(spark):
    got = {r["page_id"]: r["text"] for r in QUERIES["op7_extraction"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", lambda m: " " if m[0] == "<br>" else "", body))
        import html

        assert got[r["page_id"]] == "\n".join(y for y in (" ".join(html.unescape(x).split()) for x in parts) if y)


def test_extraction_odd_rows(spark):
    rows = [(1, None, None, 1), (1, "u", "", 1), (None, "u", "plain words only", 1), (2, "u", "<p " * 2000, 1), (3, "u", "<!-- open", 1), (4, "u", "<div><p>" * 3000 + "deep words", 1)]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")).collect()
    assert len(got) == 6 and got[0]["text"] == got[1]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in got)


def test_minimum_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(1, 9)
        cost = [rng.uniform(-3, 3) for _ in range(n)]
        links = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def energy(x):
            own = sum(max(0, -c) if on else max(0, c) for c, on in zip(cost, x))
            return own + sum(w for a, b, w in links if x[a] != x[b])

        least = min(energy([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert energy(extraction.minimum_cut(cost, links)) == pytest.approx(least)
        assert energy(extraction.max_flow_side(cost, links)) == pytest.approx(least)


# -- packing


def check_packing(rows, texts_of, tok):
    ids = {d: np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in texts_of.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        parts.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(parts):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == 2048)
            assert r["ids_crc32"] == zlib.crc32(ids[d][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[d])
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return len(by_seq), sum(len(x) for x in ids.values())


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_packing_whole(docs, tok):
    rows = packing.pack(docs, tokenizer_paths()).collect()
    n, total = check_packing(rows, texts(docs), tok)
    assert n <= total / 2048 * 1.01 + 1


def test_packing_islands(docs, tok):
    rows = packing.pack(docs, tokenizer_paths(), island=40).collect()
    n, total = check_packing(rows, texts(docs), tok)
    assert n <= total / 2048 * 1.03 + 2


@pytest.mark.parametrize("short", [0, 30])
def test_packing_ends_where_bins_cannot_be_filled(spark, short):
    rows = [(i, 0, 1100) for i in range(200)] + [(200 + i, 0, 948) for i in range(short)]
    got = packing.group(spark.createDataFrame(rows, "doc_id long, piece int, length long"), island=40).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in got) == rows
    fill = Counter()
    for r in got:
        fill[r["level"], r["island"], r["bin"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(fill) == 200


def test_packing_odd_rows(make, tok):
    rows = packing.pack(make(*ODD), tokenizer_paths()).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1 and sum(r["piece"] == 0 for r in rows if r["doc_id"] == 5) == 2
    once = packing.pack(make(*[x for x in dict(ODD).items() if x[0] is not None]), tokenizer_paths()).collect()
    check_packing(once, {d: t or "" for d, t in ODD if d is not None}, tok)
    assert packing.pack(make(), tokenizer_paths()).count() == 0


def test_encoder_equals_tokenizer(tok):
    rng = random.Random(5)
    parts = ["word", " ", "  ", "\n", "\n\n", " \n", ".", ",", "...", "it's", "É", "日本", "\xa0", " ", "\t", "12", "a", " b", "<|endoftext|>", "'ll", "\x1c", "!", "é."]
    samples = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    own = Encoder(*tokenizer_paths())
    raw = [s.encode() for s in samples]
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    ids, cut = own.ids(np.frombuffer(b"".join(raw), np.uint8), at)
    for s, a, b in zip(samples, cut, cut[1:]):
        assert ids[a:b].tolist() == tok.encode(s, add_special_tokens=False).ids, repr(s)


# -- secrets


def slow_base(text):
    pat = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(pat, text, re.I | re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def test_secrets_base(docs, make):
    rng = random.Random(2)
    bits = ["token", "Secret", "api_key", "APIKEY", " = ", ":", '"', "'", "abcdef", "0123456789", "AKIA", "ABCD", " ", "password", "-", "é", "\n", "ſecret", "toKen"]
    made = [(10_000 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for i in range(2000)]
    all_docs = make(*made, *((d, t) for d, t in texts(docs).items()))
    known = {**texts(docs), **dict(made)}
    formats = secrets.fit(docs)
    got = secrets.scan(all_docs, formats).collect()
    assert len(got) == len(known)
    for r in got:
        want = slow_base(known[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex"))
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("format")] == [f"{k}:{a}:{b}" for k, a, b in want]


def test_secrets_learnt_formats():
    rng = random.Random(6)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(300)]
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)) for _ in range(300)]
    t = [x.translate(secrets._TO_CLASS) for x in hexes]
    automaton = secrets.infer(t)
    assert len(automaton.next) < 60
    for state in automaton.logp:
        assert sum(np.exp(list(state.values()))) == pytest.approx(1, abs=1e-6)
    words = ["".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randrange(4, 12))) for _ in range(500)]
    formats = secrets.Formats({"hex": automaton, "access": secrets.infer([k.translate(secrets._TO_CLASS) for k in keys])}, secrets.bigrams(words))
    token = "ASIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(15)) + "7"
    text = f"see {token} and thereonthereonanthere99 or thereonthereonanthere"
    assert [text[a:b] for a, _, b in secrets.learnt_spans(formats, text, secrets.base_spans(text))] == [token]
    assert secrets.redact(f"x {token} y {hexes[0]}!", formats) == "x [SECRET] y [SECRET]!"


def test_secrets_candidates_are_whole_runs():
    rng = random.Random(7)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    upper = "GHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz"
    plain = [some(upper, rng.randrange(12, 16)) for _ in range(400)]
    mixed = [f"{some(upper, 3)}-{some('0123456789abcdef', 16)}-{some(upper, 6)}" for _ in range(400)]
    words = ["".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randrange(4, 12))) for _ in range(500)]
    formats = secrets.Formats({"assign": secrets.infer([v.translate(secrets._TO_CLASS) for v in plain + mixed])}, secrets.bigrams(words))
    short, token = "KqZwRtYpLmGh", "KqZ-04dbebab91ab8568-ZpQrTw"
    text = f"see {short} and {token} or thereonthereonanthere"
    base = secrets.base_spans(text)
    assert [text[a:b] for a, _, b in base] == ["04dbebab91ab8568"]
    assert [text[a:b] for a, _, b in secrets.learnt_spans(formats, text, base)] == [short, token]
    assert secrets.redact(text, formats) == "see [SECRET] and [SECRET] or thereonthereonanthere"


def test_secrets_fit_finds_a_rare_kind(make):
    keys = [f"AKIAXYZXYZXYZX{i:04d}" for i in range(5)]
    rows = make(*((i, f"plain words number {i}") for i in range(400)), *((400 + i, f"a {k} b") for i, k in enumerate(keys)))
    formats = secrets.fit(rows, max_docs=1, max_examples=3)
    assert list(formats.kinds) == ["access"]
    best = sorted(keys, key=lambda k: hashlib.md5(k.encode()).digest())[:3]
    assert formats.kinds["access"] == secrets.infer([k.translate(secrets._TO_CLASS) for k in best])


CLEAN = "1234567890123 9780306406157 978-0-306-40615-7 20200101123456 550e8400-e29b-41d4-a716-446655440000 ABCDEFGHIJKL OFTHONRETION SCHLICHCHKEIT 2020-01-01T12:34:56 www.example.com/en/196/ well-known-words"


def test_secrets_learnt_from_the_table_do_not_depend_on_its_split(spark, make):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = [secrets.fit(table.repartition(n)) for n in (1, 4, 16)]
    assert models[0] == models[1] == models[2]
    found = [r for r in secrets.scan(table, models[0]).collect() if "format" in r["spans"]]
    held = {r["doc_id"]: r["text"] for r in table.collect()}
    marked = [held[r["doc_id"]][int(x.split(":")[1]) : int(x.split(":")[2])] for r in found for x in r["spans"].split(",") if x.startswith("format")]
    assert not [m for m in marked if m.isalpha() or m.isdigit()]
    assert secrets.redact(CLEAN, models[0]) == CLEAN


def test_secrets_of_a_labelled_format_are_found_unlabelled(docs, make):
    rng = random.Random(1)
    key = lambda: "-".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(5)) for _ in range(4))
    labelled = [(20_000 + i, f"set token: {key()} now") for i in range(200)]
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    formats = secrets.fit(make(*plain, *labelled))
    planted = [key() for _ in range(20)]
    rows = make((1, CLEAN), *((10 + i, f"the words {p} stand here") for i, p in enumerate(planted)))
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(rows, formats).collect()}
    assert got[1] == "" and secrets.redact(CLEAN, formats) == CLEAN
    assert sum(got[10 + i] == f"format:10:{10 + len(p)}" for i, p in enumerate(planted)) >= 19


def test_secrets_odd_rows(make):
    got = secrets.scan(make(*ODD), secrets.fit(make(*ODD))).collect()
    assert len(got) == len(ODD) and all(r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in got)


# -- neighbours


def test_neighbours_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    norm = np.linalg.norm(x, axis=1)
    got = defaultdict(list)
    for r in sorted(QUERIES["op10_neighbours"](spark, "/root/testdata/sf0.1").collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hit = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i] / (norm * norm[i])
        near = got[int(ids[i])]
        assert len(near) == 5 and near == sorted(near, key=lambda p: (-p[1], p[0]))
        for v, score in near:
            assert score == pytest.approx(s[np.flatnonzero(ids == v)[0]], abs=1e-12)
        s[i] = -2
        hit += len({v for v, _ in near} & set(ids[np.argsort(-s, kind="stable")[:5]].tolist()))
        total += 5
    assert hit / total >= 0.9


def test_neighbours_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [1.0, None], 1), (5, [2.0, 0.0], 1), (6, [0.0, 1.0], 1), (None, [1.0, 1.0], 1), (7, [1.0], 1), (50, [1.0, 0.0], 1), (100, [1.0, 0.0], 1)]
    rows += [(200 + k, [1.0, 0.0], 1) for k in range(1, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int")
    got = defaultdict(list)
    for r in sorted(neighbours.search(df).collect()):
        got[r["query_id"]].append(r["vec_id"])
    assert got == {0: [5, 50, 100, 201, 202], 50: [0, 5, 100, 201, 202], 100: [0, 5, 50, 201, 202]}
    assert neighbours.search(df.where("false")).count() == 0


def test_slices_of_language_and_packing_are_small():
    lines = pa.array([f"wörd{i} und word{i * 7} " * 100 for i in range(2000)])
    model = language.Model(("de", "en"), np.zeros(2), np.zeros((2, language.BUCKETS), np.float32))
    language.letters()
    paths = tokenizer_paths()
    packing.encoder(paths).ids(*utf8(lines[:1]))
    for limit, work in (
        (language.SLICE_BYTES, lambda texts: language.score(model, texts.to_pylist())),
        (packing.SLICE_BYTES, lambda texts: packing.encoder(paths).ids(*utf8(texts))),
    ):
        tracemalloc.start()
        for part in by_bytes(iter([pa.RecordBatch.from_arrays([lines], names=["text"])]), "text", limit):
            work(part.column("text"))
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert peak < 40 << 20
