"""Row-wise operators against plain Python versions, odd rows and empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordlens.llm import decontaminate as dc
from recordlens.llm import packing, pii, quality, tokenfile
from recordlens.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(frame, key="doc_id"):
    """Results by id, as a multiset of rows."""
    out = {}
    for r in frame.collect():
        out.setdefault(r[key], []).append(tuple(r))
    return {k: sorted(v, key=str) for k, v in out.items()}


def expected(rows, fn):
    out = {}
    for i, t in rows:
        out.setdefault(i, []).append((i, *fn(t)))
    return {k: sorted(v, key=str) for k, v in out.items()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def base_quality(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {p + k for p, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def test_quality_base(documents, rows):
    got = quality.quality(documents).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert by_row(got) == expected(rows, base_quality)


LINE = "Here " + " ".join(f"some{i} words{i}" for i in range(25)) + " end."


def test_quality_lines(spark):
    good = "This is a plain line of some words that ends well.\n" + "Another line of prose follows the first one and stops here.\n"
    texts = [(1, good * 1 + LINE),
             (2, "\n".join(f"Home{i} | News{i} | Sport{i} | More{i} | Weather{i}." for i in range(30))),
             (3, "\n".join(f"W{i}## x{i}** y{i}%% z{i}&& more{i}$$ text{i}##" for i in range(30))),
             (4, "\n".join(f"BUY{i}!! NOW{i}!! FAST{i}!! AND{i}!! CHEAP{i}!! HERE{i}!!" for i in range(30))),
             (5, good + "Licensed under some terms, version two.\n" + LINE)]
    got = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3, 4, 5)] == [True, False, False, False, True]
    assert not any(got[i]["base_failed"] for i in (1, 2, 3, 4, 5))
    assert "Licensed" not in got[5]["clean_text"] and got[5]["n_removed_lines"] == 1


def test_quality_of_other_scripts(spark):
    """Sentences that end in the marks of their script, or in none, are sentences."""
    def lines(words, end, sep=" "):
        return "\n".join(sep.join(f"{w}{k}" for w in words) + end for k in range(12))

    texts = {1: lines("यह एक लंबा वाक्य है जो भाषा".split(), "।"), 2: lines("هل هذا سؤال طويل عن المدينة".split(), "؟"),
             3: lines("นี่ คือ ประโยค ยาว เกี่ยวกับ เมือง".split(), ""), 4: lines("no mark ends this short line".split(), "")}
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert [got[k].n_removed_lines for k in (1, 2, 3, 4)] == [0, 0, 0, 12]
    assert [got[k].kept for k in (1, 2, 3, 4)] == [True, True, True, False]


def test_quality_is_native(documents):
    plan = quality.quality(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def brute_hits(items, window=dc.WINDOW):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = {}
    for i, t in items:
        w = word.findall(lower(t or ""))
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            found.setdefault(tuple(w[k:k + m]), set()).add(i)
    sizes = {len(k) for k in found}

    def judge(text):
        w = word.findall(lower(text or ""))
        hit, names = set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if s := found.get(tuple(w[k:k + m])):
                    hit |= set(range(k, k + m))
                    names |= {str(x) for x in s if x is not None}
        return (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))

    return judge


@pytest.mark.parametrize("block_words", [2_000_000, 120])
def test_decontaminate(spark, documents, rows, block_words):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    items += [(801, "long text number 8999"), (802, "日本語 nbsp"), (803, None), (804, "!!"), (805, "ZZZ"), (None, "same text twice over"), (806, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.decontaminate(documents, bench, block_words=block_words)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = expected(rows, brute_hits(items))        # an item without an id hits, but is not counted
    assert by_row(got.select(*cols)) == want
    assert any(r[1] and not r[2] for v in want.values() for r in v)
    assert any(r[0][-1] for r in want.values())
    kept = dc.remove_contaminated(documents, bench, block_words=block_words)
    assert kept.columns == documents.columns
    assert kept.count() == sum(not r[-1] for v in want.values() for r in v)


def test_decontaminate_longest(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "a b " + " ".join(f"W{i}" for i in range(5, 25)) + " c"), (2, " ".join(f"w{i}" for i in range(9)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in dc.decontaminate(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert (got[1]["longest_match"], got[1]["longest_start"], got[1]["longest_item"], got[1]["n_hit"]) == (20, 2, "5", 20)
    assert got[2]["n_hit"] == 0 and got[2]["longest_item"] is None


def test_empty_tables(spark, empty, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert quality.quality(empty).count() == 0
    assert dc.decontaminate(empty, bench).count() == 0
    assert dc.decontaminate(documents, bench).where("contaminated").count() == 0
    assert pii.find(empty, pii.train(empty)).count() == 0
    assert packing.pack(empty, tokenizer_path("word_bpe_49k.json")).count() == 0
    path = tokenfile.write_token_files(empty, tokenfile.new_path(spark), tokenizer_path("byte_bpe_50k.json"))
    assert tokenfile.digest(spark, path).count() == 0


def pii_base(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    digits = lambda x: re.sub("[^0-9]", "", x)
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.BASE.index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ09.@%+-() _é\n", max_size=60))
def test_pii_base_spans(text):
    assert pii.base_spans(text) == pii_base(text)


def test_pii(documents, rows):
    model = pii.train(documents)
    got = by_row(pii.find(documents, model).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"))

    def want(text):
        base = pii_base(text)
        n = Counter(k for k, _, _ in base)
        return (*(n[k] for k in pii.BASE), hashlib.sha256(pii.listed(base).encode()).hexdigest())

    assert got == expected(rows, want)
    for r in pii.find(documents, model).collect():
        spans = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        assert len(spans) == r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] + r["n_added"]
    masked = pii.redact(documents, model)
    assert masked.columns == documents.columns and masked.count() == documents.count()
    assert masked.where("text rlike '[a-z0-9]@[a-z]+[.][a-z]'").count() == 0


def test_pii_redacts_rare_kinds(spark):
    """One bank account number and one disguised address among many secrets: too few to fit and to calibrate on."""
    rng = np.random.default_rng(3)
    key = ["".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789"), 32)) for _ in range(300)]
    texts = [(i, f"The api_key={k} of build {i:08d} is here.") for i, k in enumerate(key)]
    texts += [(900, "Pay to GB82 WEST 1234 5698 7654 32 today."), (901, "Ask jane.doe [at] example [dot] org for it.")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs, pii.train(docs)).collect()}
    assert got[900].startswith("iban:7:") and got[901].startswith("masked_email:4:")
    alone = docs.where("doc_id = 900")
    assert pii.find(alone, pii.train(alone)).first()["n_added"] == 1


def test_pii_threshold():
    assert pii.threshold_of([], 0.99) is None and pii.threshold_of([(9000, False, 5)], 0.99) is None
    assert pii.threshold_of([(9000, True, 99), (8000, False, 1), (7000, False, 1)], 0.99) == 8000
    assert pii.threshold_of([(10, True, 5)], 0.99) is None


def test_pii_finds_secrets_and_leaves_plain_numbers(spark):
    words = "some words of a text that goes on for a while and says nothing"
    texts = [(i, f'{words} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" {words}') for i in range(150)]
    texts += [(i, f"{words} build {hashlib.sha1(str(i).encode()).hexdigest()} {words} {i}1234567890{i} end") for i in range(150, 300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs, pii.train(docs)).collect()}
    assert all("secret:" in got[i] for i in range(150))
    assert not any("secret:" in got[i] for i in range(150, 300))


def ids_of(name, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files(spark, documents, rows):
    path = tokenfile.write_token_files(documents, tokenfile.new_path(spark), tokenizer_path("byte_bpe_50k.json"))
    encode = ids_of("byte_bpe_50k.json", 0)
    want = sorted(((i, encode(t)) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1])))
    got = sorted(map(tuple, tokenfile.digest(spark, path).collect()), key=lambda r: r[1])
    start, expect = 0, []
    for i, ids in want:
        expect.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == expect
    control = spark.read.parquet(f"{path}/shards").selectExpr("sum(length(control))", "sum(length(data))").first()
    assert control[0] + control[1] < 2 * start          # under two bytes an id


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300) | st.integers(0, 70000), max_size=40), max_size=6))
def test_variable_length_coding(documents):
    n, values = np.array([len(d) for d in documents], dtype=np.int64), [v for d in documents for v in d]
    control, data = tokenfile.pack(np.array(values, dtype="<u4"), n)
    assert tokenfile.unpack(control, data, n).tolist() == values
    assert [len(c) for c in control] == [(len(d) + 3) // 4 for d in documents]
    for d, c, b in zip(documents, control, data):         # each document can be read alone
        assert tokenfile.unpack([c], [b], np.array([len(d)])).tolist() == d


def test_piece_cache_is_bounded(monkeypatch):
    """Unspaced texts, never repeated pieces and odd spaces: the ids stay right and the kept pieces within their bytes."""
    from recordlens.llm import encode
    monkeypatch.setattr(encode, "GENERATION_BYTES", 20_000)
    enc = encode.PieceEncoder(tokenizer_path("byte_bpe_50k.json"), True)
    whole = lambda t: enc.tokenizer.encode(t, add_special_tokens=False).ids
    texts = ["".join(f"w{k}x" for k in range(3000)), "\n".join(f"一二三{k}" * 40 for k in range(50)), " ".join(f"word{k}. 一{k} and" for k in range(2000)),
             "a\tb  c", " lead", "tail ", "x\u00a0y z", "a\n\nb", "", "\n", "end.\nEnd! né", "a b\x0bc"]
    for t, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == whole(t)
        for kept in (enc.first, enc.later):
            for part in (kept, kept.old):
                assert sum(encode.ENTRY_BYTES + len(k) + len(v) for k, v in part.items()) <= 20_000 + 600
                assert all(len(k) <= encode.LONGEST_KEPT for k in part)


def test_packing(documents, rows):
    encode = ids_of("word_bpe_49k.json", 1)
    got = packing.pack(documents, tokenizer_path("word_bpe_49k.json")).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    whole = Counter()
    for r in got:
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["offset"] == 0
        assert len(r["ids"]) == 4 * r["length"] and 1 << r["bucket"] == r["length"]
        whole[r["doc_id"], r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]] += 1
    want = Counter()
    for i, t in rows:
        ids = encode(t)
        for at, size in packing.pieces_of(len(ids)):
            want[i, at, size, np.array(ids[at:at + size], dtype="<u4").tobytes(), len(ids)] += 1
    assert whole == want


@given(st.integers(0, 10 ** 6))
def test_pieces(n):
    pieces = packing.pieces_of(n)
    assert sum(s for _, s in pieces) == n
    assert [a for a, _ in pieces] == [sum(s for _, s in pieces[:k]) for k in range(len(pieces))]
    assert all(s & (s - 1) == 0 for _, s in pieces)


ODD_TEXTS = ["", " ", "a  b", "x \n y", "\n", "a\n", " a", "a b ", "don't 's 123 4,5", "tab\tx", "a  b", "a\x1cb c\x1c d", "é ́x ΑΣ σΣ b",
             "<|endoftext|> hi<|endoftext|>", "x\r\ny", "a\n\nb", "İstanbul ǅ Ñandú,", "日本 語。\n本", "it's. we'll! 'tis", "A.\nB, c: d; e?"]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(ODD_TEXTS) | st.text(alphabet="aB é'.,!\n\t  ́19<|>İ", max_size=30))
def test_pieces_encode_like_whole_texts(text):
    from recordlens.llm.encode import encoder
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        enc = encoder(tokenizer_path(name), spaces)
        assert enc.encode([text, text])[1].tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
