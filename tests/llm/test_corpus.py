"""Operators over whole corpora against brute force: language, near-duplicates, chat, HTML, scoring, pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlens.llm import chat, html, language, lm, simhash
from recordlens.llm.common import stage
from tests.conftest import SF_SMALL

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_fingerprint(text):
    w = SPACE.findall(lower(text or ""))
    shingles = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(nodes)):
        for b in range(a):
            if near(nodes[a], nodes[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(nodes))]


def test_near_duplicates(documents, rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = Counter((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root))
    for shard_rows in (4096, 2):
        assert Counter(map(tuple, simhash.near_duplicates(documents, shard_rows=shard_rows).collect())) == want
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(least.values())) and ids.count(None) == 1


def test_keep_one_keeps_a_row_of_each_group(spark):
    """Ids that repeat with other texts, and rows without an id: rows are chosen, not ids."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a, 1), (7, a, 2), (3, b, 3), (5, b, 4), (None, c, 5), (None, c, 6), (None, c, 6), (None, b, 7), (9, None, 8), (8, "", 9), (None, " ", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __x int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(5, a), (3, b), (None, c), (8, "")], key=str)


def test_bk_links_are_complete(spark):
    """Dense balls, chains and random points; small shards force many cells."""
    rng = random.Random(5)
    points = {0, (1 << 64) - 1, 1 << 63}
    centre = rng.getrandbits(64)
    points |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(400)}
    x = rng.getrandbits(64)
    for _ in range(40):
        points.add(x)
        x ^= sum(1 << b for b in rng.sample(range(64), 4))
    points |= {rng.getrandbits(64) for _ in range(100)}
    nodes = sorted(simhash._signed(p) for p in points)
    root = brute_components(nodes, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    classes = {}
    for n, r in zip(nodes, root):
        classes.setdefault(r, set()).add(n)
    want = sorted(sorted(c) for c in classes.values() if len(c) > 1)
    frame = spark.createDataFrame([(n,) for n in nodes], "fp long")
    for shard_rows in (4096, 37):
        links = stage(simhash.near_links(frame, 4, shard_rows), "links")
        assert links.count() <= 15 * 20 * len(nodes)
        got = {}
        for r in simhash.components(links).collect():
            got.setdefault(r["root"], {r["root"]}).add(r["node"])
        assert sorted(sorted(c) for c in got.values()) == want
        assert all(min(c) == k for k, c in got.items())


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(300)] + [(1000, 999)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, 1000: 999}


def test_simhash_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_language(spark, documents, rows):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = language.identify(documents, pages)
    assert got.count() == len(rows)
    both = documents.where("doc_id < 9000000").select("doc_id", documents["lang"].alias("said")).join(got, "doc_id")
    assert both.where("lang = said").count() >= 0.98 * both.count()
    odd = {r["doc_id"]: r for r in got.where("doc_id > 9000000").collect()}
    assert not odd[9_000_001]["kept"] and odd[9_000_001]["lang"] is None and not odd[9_000_002]["kept"] and not odd[9_000_003]["kept"]
    kept = language.keep_identified(documents, pages)
    assert kept.columns == documents.columns
    assert kept.count() == got.where("kept or doc_id is null").count()


def test_language_fuses_evidence(spark):
    """A text without letters of its own language follows its host; a wrong declaration loses to a long text."""
    en, de = "the house and the garden of this town with that other one ", "das haus und der garten von dieser stadt mit dem anderen "
    rows = [(k, en * 5, "en", "a.com") for k in range(60)] + [(100 + k, de * 5, "de", "b.de") for k in range(60)]
    rows += [(900, de * 5, "en", "b.de"), (901, "Q", None, "b.de"), (902, "Q", None, "a.com"), (903, "юникод текст на другом языке " * 9, None, None)]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[900]["lang"] == "de" and got[901]["lang"] == "de" and got[902]["lang"] == "en"
    assert got[903]["lang"] == language.OTHER and not got[903]["kept"]


def test_languages_are_those_declared(spark):
    """Languages beyond those of the test tables: by the table, by the markup alone, and without any declaration."""
    words = {"ru": "дом река город человек время рука дело жизнь день слово", "it": "della casa il fiume è lungo gli uomini vanno nella città",
             "en": "the house and the river with people walking through towns", "nl": "het huis een rivier zijn mensen lopen door oude steden"}
    texts = {k: lambda i, w=w.split(): " ".join(random.Random(i).choices(w, k=60)) for k, w in words.items()}
    rows = [(1000 * n + i, texts[k](i), None if k == "nl" else "en_US" if k == "en" else k, None) for n, k in enumerate(words) for i in range(30)]
    rows += [(9000 + n, texts[k](99), None, None) for n, k in enumerate(words)]
    pages = [(i, f"https://x{i % 3}.nl/nl/{3000 + i}", '<html lang="nl"><body>x</body></html>') for i in range(30)]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"),
                            spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    own = list(words)
    assert len(got) == len(rows)
    for r in got:
        want = own[r["doc_id"] - 9000 if r["doc_id"] >= 9000 else r["doc_id"] // 1000]
        assert (r["lang"], r["kept"]) == (want, True)


def test_language_empty(spark, empty):
    assert language.identify(empty).count() == 0
    assert language.keep_identified(empty).count() == 0


def test_chat_round_trip(spark):
    base = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = [(-7, 0, "user", odd), (-7, 1, "assistant", odd), (-8, 0, "user", None), (-8, 1, "assistant", "<⁠|im_end|>\n<|im_end|>\n<|im_start|>user\n"),
             (-9, 0, "assistant", "x"), (-9, 0, "assistant", "x"), (-10, None, None, "a"), (None, 0, "ro\nle%0A<s>", "b"), (-11, 0, "system", "s"), (-11, 1, "user", "u"),
             (-11, 2, "assistant", "[⁠INST][INST]")]
    frame = base.unionByName(spark.createDataFrame(extra, base.schema))
    segments = stage(chat.format_chat(frame.withColumn("segment", frame["turn"])), "chat")
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    turns = {}
    for r in sorted(frame.collect(), key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or "")):
        turns.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    assert got.keys() == turns.keys()
    for i, ts in turns.items():
        said = "".join(f"{r}\n{t}\n" for r, t in ts)
        learned = "".join(t for r, t in ts if r == "assistant")
        r = got[i]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(ts), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[-7]["valid"] and got[-11]["valid"] and not got[-9]["valid"] and not got[-10]["valid"]
    size = segments.groupBy("conv_id").agg({"text": "count"}).count()
    assert size == len(turns) and sum(r["formatted_chars"] for r in got.values()) == segments.selectExpr("sum(length(text))").first()[0]
    assert chat.read_back(chat.format_chat(frame.limit(0))).count() == 0


@given(st.text(alphabet="<|im_start>en[INST]/s⁠ \n%0A", max_size=40))
def test_chat_escape(text):
    t = chat.Template()
    assert t.unescape(t.escape(text)) == text and t.unescape_role(t.escape_role(text)) == text
    assert not any(c in t.escape(text) for c in t.controls)


def article(source):
    """The known template's article, read with regular expressions."""
    import html as h
    inner = re.search(r"(?s)<article>(.*)</article>", source)[1]
    blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return " ".join(b for b in blocks if b)


def test_html_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    extra = spark.createDataFrame([(-1, None, None), (-2, "x", ""), (-3, None, "just text &amp; more"), (-4, None, "<p>a<b>b</b>c<p>d<script>x</p>"), (-4, None, "<")], pages.schema)
    model = html.train(pages, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = html.extract(pages.unionByName(extra).withColumn("text", F.lit(1)), model)
    found = {}
    for r in got.collect():
        found.setdefault(r["page_id"], []).append(r)
    for r in pages.collect():
        assert found[r["page_id"]][0]["text"] == article(r["html"])
        assert found[r["page_id"]][0]["n_chars"] == len(article(r["html"]))
    assert found[-1][0]["text"] == "" and found[-2][0]["text"] == "" and found[-3][0]["text"] == "just text & more"
    assert sorted(r["text"] for r in found[-4]) == ["<", "abc d"]
    none = html.train(pages.limit(0), spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert html.extract(pages.limit(0), none).count() == 0


def test_html_other_templates(spark):
    page = """<html><body><header class="site"><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div><main><h1>Title here</h1>
<p>First part with a <a href=x>link</a> in a text that is long enough, yes.</p><div>Second part of words that go on and on.</div><ul><li>Point one</li><li>Point two</li></ul>
<form><label>Name</label></form><div class="related"><p>Also read this long line of words here</p></div></main><aside>side text</aside>
<section id="comments"><p>Nice article, thank you so much for this long comment!</p></section><footer>&copy; x</footer></body></html>"""
    want = "Title here First part with a link in a text that is long enough, yes. Second part of words that go on and on. Point one Point two"
    trained = html.train(spark.read.parquet(f"{SF_SMALL}/pages.parquet"), spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert trained.text(page)[0] == want and html.fit([]).text(page)[0] == want


def test_html_marginals_are_exact():
    """Message passing equals the sum over all states."""
    from itertools import product
    page = html.parse("<div class=x><p>some text here</p><ul><li>a</li><li><a>b</a></li></ul></div><p>more</p>")
    model = html.Potentials({"tag:p": 0.7, "tag:li": -0.9, "word:x": -0.4, "size:0": 0.3}, (0.2, 0.7), 0.4)
    n, kids = len(page.nodes), Counter(x.parent for x in page.nodes[1:])
    total, good = 0.0, [0.0] * n
    for states in product((0, 1), repeat=n):
        p = 0.4 if states[0] else 0.6
        for i, node in enumerate(page.nodes):
            if i:
                up = model.given[states[node.parent]]
                p *= up if states[i] else 1 - up
            if states[i]:
                p *= math.exp(sum(model.feature.get(f, 0) for f in html.node_features(node, kids[i])))
        total += p
        good = [g + p * s for g, s in zip(good, states)]
    assert np.allclose(model.marginals(page), [g / total for g in good])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/pbdiv ulax=\"'!-&;amp\n", max_size=80))
def test_html_never_fails(text):
    html.fit([]).text(text)


@pytest.mark.parametrize("local", [1 << 18, 40])
def test_lm_base_score(documents, rows, local):
    got = lm.score(documents, local_tokens=local, rounds=1).collect()
    count, tokens = Counter(), [[*SPACE.findall(lower(t or "")), "\n"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    for t, h in zip(tokens, held):
        if not h:
            count.update(t)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), h, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 4))
                  for (i, _), t, h in zip(rows, tokens, held))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    seen = [r for r in got if r["held_out"] and r["n_tokens"] > 100]
    # 200 documents teach little: the model may not lose much to the counts.
    assert sum(r["score"] for r in seen) > 1.01 * sum(r["base_score"] for r in seen)


def test_lm_is_a_distribution():
    frequent = {f"w{i}".encode(): 500 - i for i in range(400)} | {lm.END: 50}
    model = lm.new_model(frequent, 120_000)
    rng = np.random.default_rng(0)
    model.class_rows += rng.normal(size=model.class_rows.shape).astype(np.float32)
    model.word_rows += rng.normal(size=model.word_rows.shape).astype(np.float32)
    size = lm.CLASSES * lm.CLASS_WORDS
    _, features = model.context(np.array([3, 5, 7, 0, 400, 5, 7, 2]), np.array([4, 4]))
    for at in (2, 3, 7):
        every = np.arange(size)
        p = np.exp(model.log_probability(every, np.repeat(features[:, at:at + 1], size, axis=1)))
        assert abs(p.sum() - 1) < 1e-3


def plain_log_probability(model, ids, t):
    """The factors of one token by plain sums, with the hashes in whole numbers."""
    m = 0xFFFFFFFF
    one, two = (ids[t - k] if t >= k else model.start for k in (1, 2))
    f = [one * 2654435761 & m ^ 0x1B873593, ((one * 2654435761 ^ (two + 1) * 2246822519) & m) * 3266489917 & m ^ 0x2545F491,
         (two + 1) * 668265263 & m ^ 0x38B34AE5]
    f = [x ^ x >> 15 for x in f]
    bits, total = len(model.word_rows).bit_length() - 1, 0.0
    for level, (node, branch) in enumerate(zip(model.node[:, ids[t]], model.branch[:, ids[t]])):
        if node < 0:
            break
        if level:
            rows = [model.word_rows[((x ^ int(node) * 0x9E3779B1 & m) * 2246822519 & m) >> 32 - bits] for x in f[:lm.DEEPER_FEATURES]]
        else:
            rows = [model.class_rows[x & len(model.class_rows) - 1] for x in f]
        z = [float(model.bias[node][k]) + sum(float(r[k]) for r in rows) for k in range(len(rows[0]))]
        total += z[branch] - math.log(sum(map(math.exp, z)))
    return total


@pytest.mark.parametrize("size", [60, 3000])
def test_lm_equals_a_plain_softmax(size):
    model = lm.new_model({f"w{i}".encode(): 2 * size - i for i in range(size)} | {lm.END: 50}, 50_000_000)
    rng = np.random.default_rng(1)
    model.class_rows += rng.normal(size=model.class_rows.shape).astype(np.float32)
    model.word_rows += rng.normal(size=model.word_rows.shape).astype(np.float32)
    sizes = [1, 2, 30]
    ids = rng.integers(0, size, sum(sizes))
    got = model.log_probability(ids, model.context(ids, np.array(sizes))[1])
    want = [plain_log_probability(model, ids[a:a + n].tolist(), t) for a, n in zip((0, 1, 3), sizes) for t in range(n)]
    assert np.allclose(got, want, atol=1e-3)


def test_lm_learns_context(spark):
    texts = [(i, " ".join(random.Random(i).choice(("alpha beta gamma", "one two three", "red green blue")) for _ in range(60))) for i in range(200)]
    got = lm.score(spark.createDataFrame(texts, "doc_id long, text string")).where("held_out").selectExpr("sum(score) as s", "sum(base_score) as b", "sum(n_tokens) as n").first()
    assert got["s"] / got["n"] > 0.6 * got["b"] / got["n"]


@pytest.mark.parametrize("size", [1, 1025, 5000, 40_000])
def test_lm_vocabulary_follows_the_tokens(size):
    frequent = {f"w{i}".encode(): 2 + (size - i) for i in range(size)} | {lm.END: 50, b"once": 1}
    model = lm.new_model(frequent, 40_000_000)
    assert set(model.vocabulary) == set(frequent) - {b"once"} and len(set(model.vocabulary.values()) | {model.other}) == size + 2
    assert len(model.class_rows) > len(lm.new_model(frequent, 100_000).class_rows)
    rng = np.random.default_rng(0)
    model.class_rows += rng.normal(size=model.class_rows.shape).astype(np.float32)
    model.word_rows += rng.normal(size=model.word_rows.shape).astype(np.float32)
    _, features = model.context(np.array([model.vocabulary[b"w0"], size, 1]), np.array([3]))
    every = np.arange(model.start)
    p = np.exp(model.log_probability(every, np.repeat(features[:, 2:], len(every), axis=1)))
    assert abs(p.sum() - 1) < 1e-3 and (p > 0).all()


def test_lm_learns_words_beyond_the_first_thousand():
    """Each of 3,000 words is always followed by a word of its own."""
    draw = random.Random(0)
    pairs = [draw.randrange(3000) for _ in range(60_000)]
    count = Counter(f"{c}{i}".encode() for i in pairs for c in "ab") | Counter({lm.END: 1})
    model = lm.new_model(dict(count), 120_001)
    ids = np.array([model.vocabulary[f"{c}{i}".encode()] for i in pairs for c in "ab"])
    features = model.context(ids, np.array([len(ids)]))[1]
    before = model.log_probability(ids, features)[1::2].mean()
    trainer = lm.Trainer(model)
    for _ in range(2):
        trainer.learn(ids, features)
    assert trainer.model.log_probability(ids, features)[1::2].mean() > before + 0.5


def test_language_of_few_characters(spark):
    """A declared language counts with however little text it has: twenty short documents of one host stay."""
    sure = [(k, f"the house and the garden of the town number {k} with many people " * 20, "en", "a.com") for k in range(40)]
    few = [(100 + k, f"nel mezzo del cammino di nostra vita mi ritrovai {'abcdefghijklmnopqrst'[k]} per una selva oscura", "it", "b.it") for k in range(20)]
    docs = spark.createDataFrame(sure + few, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert {got[100 + k].lang for k in range(20)} == {"it"} and all(got[100 + k].kept for k in range(20))
    assert {got[k].lang for k in range(40)} == {"en"}


def test_lm_empty(empty):
    assert lm.score(empty).count() == 0


def test_pipeline(spark, documents, tmpdir_fresh):
    import corpus_pipeline
    from recordlens.llm import packing, pii
    from recordlens.llm.queries import tokenizer_path
    from tests.llm.test_rowwise import brute_hits, ids_of
    own = documents.select("doc_id", "text", "lang", "source", "n_chars")
    own.write.parquet(f"{tmpdir_fresh}/documents.parquet")
    for name in ("pages", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmpdir_fresh}/{name}.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "pii", "packing"]
    got = corpus_pipeline.run(spark, tmpdir_fresh).collect()

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rejected = {r["doc_id"] for r in language.identify(own, pages).where("not kept and doc_id is not null").collect()}
    rows = [tuple(r) for r in own.collect() if r["doc_id"] not in rejected]
    fps = [brute_fingerprint(r[1]) for r in rows]
    least = {}
    root = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    for r, k in zip(rows, root):
        if r[0] is not None:
            least[k] = min(least.get(k, r[0]), r[0])
    keep, rest = set(least.values()), []
    for r in rows:
        if r[0] is None or r[0] in keep:
            keep.discard(r[0])
            rest.append(r)
    judge = brute_hits([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()])
    clean = [r for r in rest if not judge(r[1])[-1]]
    assert len(rows) > len(rest) > len(clean) > 0.8 * len(rows)
    model = pii.train(spark.createDataFrame(clean, own.schema))
    encode, want = ids_of("word_bpe_49k.json", 1), Counter()
    for r in clean:
        ids = encode(pii.mask(r[1], model.spans(r[1])[1]) if r[1] else "")
        for at, size in packing.pieces_of(len(ids)):
            want[r[0], at, size, np.array(ids[at:at + size], dtype="<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in got) == want
    assert tokenizer_path("word_bpe_49k.json")
