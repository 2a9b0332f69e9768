"""URL rules, language model, quality, archives, chats, packing."""

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import chat, ngrams, packing, quality, stages, urls, warc
from eventloom.llm.blocks import shared_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    docs = brute.odd_documents()
    return docs, brute.as_table(spark, docs).cache()


# --- URL filter ---------------------------------------------------------------


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = brute.lower(rest[:cut]), rest[cut:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h + p), h + p, verdict)
        for h, p, verdict in [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_url_rules(spark):
    given = [
        None, "", "no scheme.net/", "http://a.net/x", "http://A.NET", "https://net/", "http://x.example.net/en/1?q=://z",
        "http://example.net/en", "http://notexample.com/de/", "http://example.com/de/#f", "http://B.org/fr/é\n", "http://org?x/fr/",
        "ftp://u:p@h.ÄÖ.net:80/", "a://b://c.net/", "http://example.com.net/de/", "://net/", "http://x.net/x",
    ]
    pages = [(n, u) for n, u in enumerate(given)] + [(3, given[3])] * 2 + [(None, given[3]), (None, None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string").withColumns({"rule": F.lit(1), "token": F.lit(2), "host": F.lit("h")})
    got = brute.rows_of(urls.judge_urls(df), "page_id", "host", "path", "rule", "verdict")
    assert got == brute.ordered([(n, *judge(u)) for n, u in pages])
    assert urls.judge_urls(df.where("false")).count() == 0


def test_url_rules_of_any_pattern(spark):
    rules = [
        urls.Rule("ads", "block", r"/ads?/", ("ads",), 1),
        urls.Rule("any", "block", r"\.exe$", (), 2),
        urls.host_rule("allow", "good.org", ""),
    ]
    df = spark.createDataFrame([(1, "http://a.b/ads/x"), (2, "http://a.b/x.exe"), (3, "http://x.good.org/ads/y.exe"), (4, "http://a.b/")], "page_id bigint, url string")
    got = brute.rows_of(urls.judge_urls(df, rules), "page_id", "rule", "verdict")
    assert got == [(1, "ads", "block"), (2, "any", "block"), (3, "good.org", "allow"), (4, None, "allow")]
    assert brute.rows_of(urls.judge_urls(df, []), "verdict") == [("allow",)] * 4


def test_rarest_token_is_the_index(spark):
    df = spark.createDataFrame([("a.net", "/en/", 5), ("example.net", "/", 1)], "host string, path string, copies bigint")
    rules = spark.createDataFrame([(r.rule, r.verdict, r.pattern, list(r.tokens), r.rank) for r in urls.RULES], urls.RULE_SCHEMA)
    index = {r.rule: r.token for r in urls.rule_index(rules, df).collect()}
    assert index["example.net/en/"] == "example" and index["net/"] == "net"


# --- language model -----------------------------------------------------------


def lm(docs, order=3, backoff=0.4, least=2):
    split = [brute.SPACED.findall(brute.lower(t or "")) for _, t in docs]
    counts = Counter(tuple(w[i : i + n]) for w in split for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, split))
    out = []
    for (doc, _), words in zip(docs, split, strict=True):
        used, score = [0] * (order + 1), 0
        for i in range(len(words)):
            deepest = min(i + 1, order)
            n = next((n for n in range(deepest, 0, -1) if counts[tuple(words[i + 1 - n : i + 1])] >= least), 0)
            if n > 1:
                ratio = counts[tuple(words[i + 1 - n : i + 1])] / counts[tuple(words[i + 1 - n : i])]
            else:
                ratio = (counts[(words[i],)] if n else 1) / total
            used[n] += 1
            score += round((math.log(ratio) + (deepest - max(n, 1)) * math.log(backoff)) * 1e6)
        out.append((doc, len(words), *used, score))
    return out


def test_lm_scores(odd, monkeypatch):
    docs, df = odd
    monkeypatch.setattr("eventloom.llm.blocks.BLOCK_BYTES", 3000)
    got, want = brute.rows_of(ngrams.lm_report(df)), brute.ordered(lm(docs))
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert all(abs(a[-1] - b[-1]) <= a[1] for a, b in zip(got, want, strict=True))  # last bit of a logarithm
    assert ngrams.lm_report(df.where("false")).count() == 0


def test_lm_of_other_orders(odd):
    docs, df = odd
    rows = ngrams.lm_scores(df, order=2, backoff=0.5, least_count=1)
    got = brute.rows_of(rows.select("doc_id", "n_words", *[F.col("by_order")[n] for n in range(3)]))
    assert got == brute.ordered([r[:-1] for r in lm(docs, 2, 0.5, 1)])


# --- quality ------------------------------------------------------------------


def test_quality(odd):
    docs, df = odd
    more = [(100, "# " * 60), (101, "same line here\n" * 30), (102, "a b c " * 20), (103, "x" * 90 + " y" * 49), (104, "<é> " + " ".join(map(str, range(60))))]
    df = df.select("doc_id", "text").union(df.sparkSession.createDataFrame(more, "doc_id bigint, text string"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = brute.rows_of(quality.quality_report(df), *names)
    assert got == brute.ordered([(d, *brute.quality(t)) for d, t in [*docs, *more]])
    assert quality.quality_report(df.where("false")).count() == 0


def test_ledger_policies_and_ablation(spark):
    fine = " ".join(f"word{n}" for n in range(80))
    docs = [(1, fine), (2, "few"), (3, "&&&& " * 70), (4, None), (5, fine.replace(" ", " $$$$$ "))]
    df = brute.as_table(spark, docs)
    ledger = quality.quality_ledger(df)
    assert brute.rows_of(quality.keep_good(df), "doc_id") == [(1,)]
    assert brute.rows_of(quality.keep_good(df, quality.BASE), "doc_id") == [(1,), (5,)]
    assert quality.keep_good(df).columns == df.columns
    found = {r["rule"]: (r.failing, r.only_this) for r in quality.ablation(ledger, quality.STRICT).collect()}
    failed = {r.doc.doc_id: r.failed for r in ledger.collect()}
    for rule, bit in quality.BIT.items():
        assert found[rule] == (sum(bool(f & bit) for f in failed.values()), sum(f == bit for f in failed.values()))


# --- WARC ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    same, other = "<p>same</p>", "<p>é\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(1, "http://a/1", same), (2, "http://a/ 2\r\nX: y", same), (9, None, same), (9, "http://a/9", same), (3, "http://b/é", other), (4, "u", None), (5, "u", ""), (None, "http://n", same), (None, "z", "alone"), (6, "http://long", "x" * 600_000)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"digest": F.lit(1), "salt": F.lit(2), "payload": F.lit(3)})


def test_archives(spark, pages):
    got = brute.rows_of(warc.archive_report(spark, pages), "page_id", "payload_bytes", "record_type", "refers_to")
    assert got == brute.ordered([
        (1, 11, "revisit", 9), (2, 11, "revisit", 9), (9, 11, "response", None), (9, 11, "response", None), (3, 23, "response", None),
        (4, 0, "revisit", 5), (5, 0, "response", None), (None, 11, "revisit", 9), (None, 5, "response", None), (6, 600_000, "response", None),
    ])
    assert warc.archive_report(spark, pages.where("false")).count() == 0


def test_one_record_by_its_frame(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    manifest = warc.write_archives(warc.plan_records(pages.coalesce(1)), shared_path(spark, "warc"))
    rows = [r.asDict() for r in manifest.collect()]
    assert max(r["frame"] for r in rows) > 1 and len(rows) == 10
    for row in rows:
        record = warc.read_record(row)
        assert (record["page_id"], record["record_type"]) == (row["page_id"], row["record_type"])
    long = next(r for r in rows if r["page_id"] == 6)
    assert warc.read_record(long)["payload"] == b"x" * 600_000


def test_least_bytes_keeps_small_copies(spark, pages):
    kinds = brute.rows_of(warc.plan_records(pages, least_bytes=1), "page_id", "record_type")
    assert (4, "response") in kinds and (1, "revisit") in kinds


def test_bundles_are_plain_zstandard(spark, pages):
    import zstandard

    manifest = warc.write_archives(warc.plan_records(pages), shared_path(spark, "warc"))
    path = manifest.first().path.removeprefix("file://")
    with open(path, "rb") as file:
        plain = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\nWARC-Type: ") == manifest.where(F.col("path") == manifest.first().path).count()


def test_bundles_are_read_by_frames_in_many_tasks(spark):
    rows = [(n, f"http://e/{n}", f"<p>{n}" + "x" * (n % 50) * 100) for n in range(2000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(200)
    manifest = warc.write_archives(warc.plan_records(pages).repartition(200), shared_path(spark, "warc"))
    assert manifest.select("path").distinct().count() == 200
    read = warc.read_archives(manifest, task_bytes=200_000)
    assert 5 < read.rdd.getNumPartitions() < 200
    got = {r.page_id: bytes(r.payload).decode() for r in read.collect()}
    assert got == {n: html for n, _, html in rows}
    wanted = manifest.where("page_id % 100 = 7")  # some records only, wherever they lie
    assert sorted(r.page_id for r in warc.read_archives(wanted).collect()) == list(range(7, 2000, 100))


# --- chats --------------------------------------------------------------------


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 0, "message", "user", "Hi"), (1, 1, 0, "message", "assistant", None), (1, 1, 1, "delta", None, "He"), (1, 1, 2, "delta", None, "llo"),
        (1, 0, 5, "edit", None, "Hi there"), (1, 1, 6, "regenerate", None, None), (1, 1, 7, "delta", None, "Good "), (1, 1, 8, "delta", None, "day"),
        (2, 0, 3, "delta", None, "b"), (2, 0, 1, "delta", "user", "a"), (None, 0, 0, "message", None, None),
    ]
    df = spark.createDataFrame(log, "conv_id bigint, message bigint, seq bigint, kind string, role string, text string")
    got = brute.rows_of(chat.fold_events(df))
    assert got == brute.ordered([(1, 0, "user", "Hi there"), (1, 1, "assistant", "Good day"), (2, 0, "user", "ab"), (None, 0, "", "")])


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok", "<|turn|>user\nx<|end|>\n", "&l;&a;&n;", "", None, "é<&\n", "plain"]
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\n<b", None]), rng.choice(nasty)) for c in [1, 2, 3, None] for t in range(9)]
    rows += [(1, 3, "assistant", "tie"), (1, 3, "assistant", "tie"), (5, None, "assistant", "no turn")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"message": F.lit(1), "seq": F.lit(2)})
    want = []
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1], r[2] is not None, r[2], r[3] is not None, r[3]))
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        want.append((conv, len(turns), brute.sha(said), len(loss), brute.sha(loss)))
    got = brute.rows_of(chat.chat_report(df), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == brute.ordered(want)
    assert chat.chat_report(df.where("false")).count() == 0


def test_loss_spans_mark_assistant_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "a<b"), (1, 1, "assistant", "c&d"), (1, 2, "assistant", "")], "conv_id bigint, turn bigint, role string, text string")
    row = chat.format_chats(chat.fold_events(chat.turns_as_events(df))).first()
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == ["c&a;d", ""]


# --- packing ------------------------------------------------------------------


def test_packing(odd):
    from tokenizers import Tokenizer

    docs, df = odd
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rows = packing.pack(df, capacity=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    for doc in {d for d, _ in docs}:
        found = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc])
        for _, text in [d for d in docs if d[0] == doc]:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
            at = 0
            while at < len(ids):  # some chain of pieces gives the whole document
                fits = [p for p in found if p[0] == at and p[3] == len(ids) and zlib.crc32(ids[at : at + p[1]].tobytes()) == p[2]]
                assert fits
                found -= Counter([fits[0]])
                at += fits[0][1]
        assert not found
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda r: r.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= 64
        padding += 0 if at & (at - 1) == 0 else 64 - at
    assert padding < 0.15 * sum(r.length for r in rows)
    assert packing.pack(df.where("false")).count() == 0


def test_small_memory_of_words_gives_the_same_ids(odd):
    docs, _ = odd
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        definition = file.read()
    texts = [(text or "").encode() for _, text in docs]
    plain, forgetful = packing.Encoder(definition), packing.Encoder(definition)
    forgetful.words.limit = 3000
    wanted = [ids.tolist() for ids in plain.encode(texts)]
    assert [ids.tolist() for ids in forgetful.encode(texts)] == wanted
    assert forgetful.words.old and forgetful.words.size <= 3000


def test_capitals_and_symbols_behind_letters_need_no_whole_encoding():
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    texts = ["Éreeauou ßàíÿ ÀÖØÞ×à", "gestö### eablehe%%%, Éçpa.&&& it's$ a-b* x)* 5% le'* <|a|>*"]
    wanted = [[*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2] for text in texts]
    assert [ids.tolist() for ids in encoder.encode([text.encode() for text in texts])] == wanted
    asked = []

    class Whole:
        def encode(self, word, **options):
            asked.append(word)
            return whole.encode(word, **options)

    whole, encoder.tokenizer = encoder.tokenizer, Whole()
    for word in ("Éreeauoux", "gestön###", "eablehen%%%,", "Éçpan.&&&"):
        encoder.words[word.encode()]
    assert not set("aeößçé") & set("".join(asked))  # at most marks alone


def test_the_late_stage_remembers_fewer_words(spark):
    docs = spark.createDataFrame([(n, f"word{n} some Text.") for n in range(50)], "doc_id bigint, text string").coalesce(1)
    assert 0 < packing.REMEMBERED_LATE < packing.REMEMBERED
    usual, small = packing.pack(docs).collect(), packing.pack(docs, remembered=2000).collect()
    assert sorted(usual) == sorted(small) == sorted(stages.packing_stage(spark, docs, "").collect())


def test_other_tokenizers_encode_whole_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    with open(path, encoding="utf-8") as file:
        assert not packing.cuts_at_spaces(file.read())
    docs = [(1, "Two  spaces, a Tab\tand\nlines."), (2, None), (3, "Étage 12")]
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(spark.createDataFrame(docs, "doc_id bigint, text string"), tokenizer=path).collect()
    for doc, text in docs:
        wanted = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(wanted)
        for r in pieces:
            part = np.array(wanted[r.start : r.start + r.length], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_cuts_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.randint(3, 12)
        gaps = [rng.randint(1, capacity) for _ in range(rng.randint(1, 14))]
        cuts = np.cumsum([0, *gaps])
        costs = np.array([0, *[rng.choice([0, 4, 48]) for _ in gaps]])

        def cost(ends):
            starts = [0, *ends[:-1]]
            total = sum(capacity - (b - a) for a, b in zip(starts, ends, strict=True))
            return total + sum(int(costs[np.searchsorted(cuts, e)]) for e in ends)

        least = {0: 0}
        for j in range(1, len(cuts)):
            least[j] = int(costs[j]) + min(
                least[i] + capacity - int(cuts[j] - cuts[i]) for i in range(j) if cuts[j] - cuts[i] <= capacity
            )
        ends = packing.best_cuts(cuts, costs, capacity, last=True)
        assert ends[-1] == cuts[-1] and cost(ends) == least[len(cuts) - 1]


def test_shelves_carry_open_windows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHELF", 100)
    docs = [(n, "some words go here and there. more of them follow! " * (n % 5)) for n in range(40)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), capacity=32).collect()
    total = sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert sum(r.length for r in rows) == total
    order = [(r.doc_id, r.start) for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    assert order == sorted(order)
