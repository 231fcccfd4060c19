"""Corpus operators against brute force, and their results on nulls, empties, ties and repeats."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from ledgerline.llm import chat, decontam, encoders, langid, linededup, mixing, neardup, pii, quality, queries, tokens, urlrules, words

LONG = "alpha beta gamma delta " * 30_000
#: Null ids and texts, empty and white-space texts, a repeated row, one id with two texts, a very
#: long text, and columns whose names clash with the operators' own.
EDGE = [(1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1), (2, None, "en", "a", 1),
        (3, "", None, None, 1), (4, " \t\n ", "en", "b", 1), (None, "no id but words to read here", "en", "b", 1),
        (5, LONG, "en", None, 1), (6, "same row", "en", "c", 1), (6, "same row", "en", "c", 1), (7, "one text of id seven", "en", "c", 1),
        (7, "another text of id seven", "en", "c", 1), (8, "1234 5678", "en", "a", 1)]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def edge(spark):
    clash = ["size", "n_words", "words", "cls", "key", "draw", "epochs", "runs", "host", "kept", "file", "part"]
    return spark.createDataFrame(EDGE, COLUMNS).select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k=4, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in ids}


def copies(seed=3):
    """A base text, many copies with a few edits each, truncations, and texts sharing half."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(80)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(words[:3] if i % 3 else words)
        rows.append((i, " ".join(w if i % 5 else w[:rng.randint(55, 80)])))
    for i in range(60, 80):
        rows.append((i, " ".join(base[:40] + [rng.choice(words) for _ in range(40)])))
    return rows + [(80, rows[5][1].upper()), (81, rows[5][1] + "\n"), (82, "a b"), (83, "A  b"), (84, "")]


def test_near_duplicates_brute_force(spark, small):
    for rows in (copies(), [(r.doc_id, r.text) for r in small.collect()]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k=4).collect()}
        assert got == brute_components(rows)


def test_near_duplicates_edges(spark, edge):
    got = neardup.near_duplicates(edge, k=4).collect()
    assert len(got) == len(EDGE)
    by = {(r.doc_id, r.n_shingles): r for r in got}
    assert by[(2, 0)].component_id == 2 and by[(2, 0)].kept and by[(4, 0)].kept
    assert all(r.component_id == r.doc_id for r in got if r.doc_id in (6, 7))
    assert neardup.near_duplicates(edge.limit(0), k=4).count() == 0
    out = neardup.drop_near_duplicates(edge, k=5)
    assert out.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8]


def test_drop_near_duplicates_by_row(spark):
    """Exactly one row of each group stays: copies without ids, an id with a kept and a dropped row, repeated rows."""
    rng = random.Random(11)
    base, other, third = (" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(3))
    rows = [(5, base), (6, base + " end"), (5, ""), (5, ""), (6, third), (None, other), (None, other), (None, other + " x"), (None, ""), (None, None),
            (9, third), (7, third), (None, third)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit("clash"))
    out = [(r.doc_id, r.text) for r in neardup.drop_near_duplicates(df, k=5).collect()]
    # base, base end and third (both of id 6) are one group, which also holds third's other rows
    assert sorted(out, key=str) == sorted([(5, base), (5, ""), (None, ""), (None, None), out[[t in (other, other + " x") for _, t in out].index(True)]], key=str)
    assert len(neardup.drop_near_duplicates(df.where("false")).collect()) == 0


def test_near_duplicates_null_ids(spark):
    rng = random.Random(8)

    def edited(w, at):
        return w[:at] + ["edit"] + w[at + 1:]
    rows = []
    for ids in ((None, 1, 2), (None, None, None), (3, None, 4)):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(100)]
        rows += zip(ids, map(" ".join, (base, edited(edited(base, 10), 30), edited(edited(base, 60), 80))))
    rows += [rows[0], rows[4]]
    # null ids as large ids of their own
    named = [(1000 + n if i is None else i, t) for n, (i, t) in enumerate(rows)]
    tops = {i: (size, top if top < 1000 else None) for i, (size, top) in brute_components(named).items()}
    want = sorted(((i, *tops[own], i == tops[own][1]) for (i, _), (own, _) in zip(rows, named)), key=str)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in neardup.near_duplicates(df, k=4).collect()]
    assert sorted(got, key=str) == want
    assert {top for _, top in tops.values()} == {1, 3, None}


def brute_contamination(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for p in range(len(w) - n + 1) if n else ():
            if tuple(w[p:p + n]) in grams:
                hit |= {*range(p, p + n)}
                ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_chars", [decontam.BLOCK_CHARS, 60])
def test_decontamination_brute_force(spark, block_chars):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([25, 10, 9, 3, 1, 40, 12])]
    items += [(7, "v1 v1 v1 v1 v1 v1 v1 v1 v1 v1 v1"), (8, ""), (9, None), (10, items[0][1])]
    rows = []
    for i in range(60):
        text = [rng.choice(vocab[3:]) for _ in range(rng.randint(0, 60))]
        passage = rng.choice(items[:8])[1].split()
        cut = rng.randint(0, len(passage))
        text[5:5] = passage[cut:] if i % 2 else passage
        rows.append((i, rng.choice([" ", ", ", "-\n"]).join(text).title()))
    rows += [(60, None), (61, ""), (62, "v1 " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination_report(docs, bench, block_chars=block_chars).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute_contamination(t, items) for i, t in rows}


def test_decontamination_edges(spark, edge):
    bench = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    out = decontam.decontaminated(edge, bench)
    assert out.columns == edge.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 2, 3, 4, 5, 6, 6, 7, 7, 8]
    many = decontam.decontaminated(edge, bench, block_chars=3, blocks_at_once=1)
    assert sorted(r.doc_id or 0 for r in many.collect()) == [0, 2, 3, 4, 5, 6, 6, 7, 7, 8]
    assert decontam.contamination_report(edge, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(edge.limit(0), bench).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_path())


def test_pieces_encode_like_whole_texts(library):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", "\x85", "\x1c", "word", "Été", "'s", "don't", "123", "!?",
             "日本", "é", " the", "<|endoftext|>", "́", "\x00", "𝒳", "\U0001F600"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        encoder = encoders.ByteLevelEncoder(f.read(), remembered=2000)
    for at in range(0, len(texts), 1000):
        ids, offsets, _ = encoder.encode(pa.array(texts[at:at + 1000]))
        for i, t in enumerate(texts[at:at + 1000]):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


def test_token_files(spark, small, edge, library):
    got = {r.doc_id: r for r in tokens.token_table(small, queries.tokenizer_path()).collect()}
    start = 0
    for r in sorted(small.collect(), key=lambda r: r.doc_id):
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows = tokens.token_table(edge, queries.tokenizer_path(), length=8).orderBy("start").collect()
    assert len(rows) == len(EDGE) and rows[0].doc_id is None
    assert [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [1, 1]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
    assert tokens.token_table(edge.limit(0), queries.tokenizer_path()).count() == 0


def test_sequence_file(tmpdir_path):
    ids = np.arange(1, 1001, dtype=np.uint16)
    writer = tokens.SequenceWriter(f"file://{tmpdir_path}/x.arrow", 7, np.uint16)
    for at in range(0, 1000, 130):
        writer.write(ids[at:at + 130])
    writer.close()
    file = tokens.SequenceFile(f"file://{tmpdir_path}/x.arrow")
    assert file.tokens(444, 20).tolist() == list(range(445, 465))
    row, mask = file.sequence(142)
    assert row.tolist() == [995, 996, 997, 998, 999, 1000, 0] and mask.tolist() == [True] * 6 + [False]


def test_mixture(spark, edge):
    rows = [(i, f"{'w ' * (i % 7 + 1)}", f"s{i % 4}" if i % 4 else None) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    assert len(got) == 4000 and all(r.taken in (0, r.size, 2 * r.size) for r in got)
    total = sum(r.size for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * total) < 1e-6 * total
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert own[0].target <= 2 * own[0].source_size + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= 14
    edges = mixing.mixture(edge)
    assert edges.count() == len(EDGE) and {r.size for r in edges.where("doc_id in (2, 3, 4)").collect()} == {0}
    assert mixing.mixture(edge.limit(0)).count() == 0
    out = mixing.mixed(edge)
    assert out.columns == edge.columns
    want = {(r.doc_id, r.size): r.epochs for r in edges.collect()}
    assert out.count() == sum(r.epochs for r in edges.collect()), want
    assert sorted(map(str, mixing.mixed(docs).collect())) == sorted(map(str, mixing.mixed(docs).collect()))


def test_pii(spark, small, edge):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    def base(text):
        out = []
        for rank, (kind, pattern) in enumerate(kinds.items()):
            for m in re.finditer(pattern, text or ""):
                d = re.sub("[^0-9]", "", m.group())
                ok = {"email": True, "ip": kind != "ip" or max(map(int, m.group().split("."))) <= 255,
                      "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
                if ok:
                    out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        return ",".join(s for _, _, s in sorted(out))

    rng = random.Random(2)
    parts = ["a@b.c", "@", ".", "x.y@z-1.co.uk_q@r.s", "1.2.3.4", "256.1.1.1", "001.02.3.4.5.6.7", "4111 1111 1111 1111", "4755575702902891",
             "+1 (434) 555-2368", "+49-", " ", "é", "5", "-", "+", "GB82 WEST 1234 5698 7654 32", "call 434-555-2368", "1" * 30, "\n"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(400)]
    rows += [(r.doc_id + 1000, r.text) for r in small.collect()]
    rows += [(9001, "a" * 200_000), (9002, "1" * 200_000), (9003, "a@b" + ".c" * 50_000), (9004, None), (9005, "1 " * 50_000)]
    got = pii.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    texts = dict(rows)
    for r in got:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (texts[r.doc_id][:80], want, r.spans)
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want.split(",")) for k in kinds]
    found = pii.report(spark.createDataFrame([(1, "iban GB82 WEST 1234 5698 7654 32"), (2, "call 434-555-2368"), (3, "see 434-555-2368"),
                                              (4, "GB83 WEST 1234 5698 7654 32")], "doc_id long, text string"))
    assert {r.doc_id: r.spans for r in found.collect()} == {1: "iban:5:32", 2: "local_phone:5:17", 3: "", 4: ""}
    assert pii.report(edge).count() == len(EDGE) and pii.report(edge.limit(0)).count() == 0


def test_iban_followed_by_words(spark):
    texts = {"GB82 WEST 1234 5698 7654 32 Thanks": "iban:0:27", "DE89 3704 0044 0532 0130 00 BIC COBADEFF": "iban:0:27",
             "DE89370400440532013000 2024": "iban:0:22", "Konto DE89 3704 0044 0532 0130 00 Danke": "iban:6:33",
             "AB12 GB82 WEST 1234 5698 7654 32 X": "iban:5:32", "NO93 8601 1117 947 NO93 8601 1117 947": "iban:0:18,iban:19:37",
             "ZZ66 0000 0000 0000 00 AND MORE": "iban:0:22", "DE89 3704 0044 0532 0130 01 BIC": "", "DE89 3704 0044 0532 0130 00Thanks": "",
             "AB12 " * 20_000: "", "AB12" + "C" * 200_000: ""}
    got = pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.spans for r in got] == list(texts.values())


def test_chat_round_trip(spark):
    rng = random.Random(4)
    parts = ["\\", "\\h", "\\t", "\\c", "### ", "</turn>", "</turn>\n", ": ", "#", "<", "é", "x ", "\n", "Assistant", "\\\\"]
    turns = [(c, t, rng.choice(["user", "assistant", "system", "we:ird ### \\r", None]),
              rng.choice([None, ""] + 6 * ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))]))
             for c in range(60) for t in range(rng.randint(1, 9))]
    turns += [(None, 0, "user", "no id"), (70, None, "user", "no turn"), (70, 1, "assistant", "tie b"), (70, 1, "assistant", "tie a"),
              (71, 0, "assistant", LONG)] + [(72, t, "assistant", f"t{t} ") for t in range(700)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("block"))
    formatted = chat.format_conversations(df)
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert len(got) == len({t[0] for t in turns})
    for conv, r in got.items():
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        told = "".join(f"{role}\n{text}\n" for *_, role, text in own)
        loss = "".join(text for *_, role, text in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(texts[conv])
        assert texts[conv].count("</turn>") == len(own) == texts[conv].count("### ")
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_url_rules(spark):
    rng = random.Random(6)
    hosts = ["com", "example.com", "www.example.com", "a.b.example.com", "net", "x.net", "notexample.com", ".com", "WWW.Example.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/1", "/EN/", "/es/x", "/fr/", "/en/a/b", "é/en/"]
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=://x/', '#t/en/'])}") for i in range(400)]
    rows += [(400, None), (401, "no scheme"), (402, "://"), (402, "://com/"), (None, "http://com/en/" + "y" * 5000)]
    rules = [*queries.URL_RULES, ("example.com", "/en/a", "allow"), ("example.com", "/", "block"), ("COM", "/e", "block"), (None, "/", "block")]
    want = []
    for i, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = (re.match(r"[^/?#]*", rest).group(), re.match(r"[^/?#]*([^?#]*)", rest).group(1))
        host = lower(host)
        fits = [(len(h + p), len(h), lower(h) + p, v) for h, p, v in rules if h and (host == lower(h) or host.endswith("." + lower(h))) and path.startswith(p)]
        want.append((i, host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string").select("*", F.lit("z").alias("host"), F.lit("z").alias("rule"))
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    for sweep_rows in (50_000, 20):
        got = urlrules.judge(pages, table, sweep_rows=sweep_rows).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert urlrules.judge(pages.limit(0), table).count() == 0
    assert {r.verdict for r in urlrules.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_line_dedup(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", f"<p>menu</p><p>body {i}</p>" + ("<br>foot" if i % 4 == 1 else "")) for i in range(20)]
    rows += [(20, None, "<p>menu</p>"), (21, "http://h0.org/", None), (21, "http://h0.org/", ""), (22, "http://tiny.org", "<p>menu</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit(0))
    got = {(r.page_id, r.host): r for r in linededup.drop_boilerplate(pages, ratio=0.5).collect()}
    assert got[(0, "h0.org")].text == "body 0" and got[(0, "h0.org")].n_dropped == 1
    assert got[(1, "h1.org")].text == "body 1\nfoot"  # half of the pages do not exceed the ratio
    assert got[(20, "")].text == got[(22, "tiny.org")].text == "menu" and got[(21, "h0.org")].n_lines == 0
    assert linededup.drop_boilerplate(pages).count() == len(rows) and linededup.drop_boilerplate(pages.limit(0)).count() == 0


def test_line_dedup_small_hosts(spark):
    rows = [(i, f"http://h{n}.org/{i}", f"<p>menu</p><p>body {i}</p>") for n in (1, 2, 3, 4) for i in range(10 * n, 11 * n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in linededup.drop_boilerplate(pages).collect()}
    assert got == {i: f"menu\nbody {i}" if i == 10 else f"body {i}" for i, _, _ in rows}


def test_quality(spark, edge):
    def brute(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        seen, cover = {}, set()
        for i in range(len(w) - 4):
            seen.setdefault(tuple(w[i:i + 5]), []).append(i)
        for at in seen.values():
            cover |= {p + j for p in at if len(at) > 1 for j in range(5)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover), failed)

    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c\n", "é ", " x", "#", "\t"]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    got = quality.quality(spark.createDataFrame(rows + [(900, LONG), (901, None)], "doc_id long, text string")).collect()
    texts = dict(rows) | {900: LONG, 901: None}
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert quality.quality(edge).count() == len(EDGE) and quality.quality(edge.limit(0)).count() == 0


def test_language(spark, edge):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    aside = langid.held_out(F.col("doc_id"))
    model = langid.train(docs, usable=~aside)
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(aside).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.accepted for r in rows) >= 0.99 * len(rows)
    held = {r.doc_id for r in docs.where(aside).select("doc_id").collect()}
    assert held == {r.doc_id for r in docs.select("doc_id").collect() if langid.held_out_id(r.doc_id)}
    again = langid.train(docs, usable=~aside)
    assert np.array_equal(model.table, again.table) and model.threshold == again.threshold
    # labels of held-out rows and the columns lang and source never matter
    other = docs.withColumn("lang", F.when(aside, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert np.array_equal(model.table, langid.train(other, usable=~aside).table)
    got = {r.doc_id: r for r in langid.identify(edge, model).collect()}
    assert {got[i].lang_pred for i in (2, 3, 4, 8)} == {"und"} and got[1].lang_pred == "en"
    assert langid.identify(edge.limit(0), model).count() == 0
    assert langid.train(edge.limit(0)) is None and langid.identify(edge, None).where("accepted").count() == 0
    out = langid.accepted_rows(edge, model)
    assert out.columns == edge.columns and not {2, 3, 4, 8} & {r.doc_id for r in out.collect()}


def test_pipeline(spark):
    import corpus_pipeline
    from ledgerline.llm.scratch import written

    sf = SF_SMALL
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, kept, sf), f"test-{name}")
        assert out.columns == docs.columns
        before, after = {r.doc_id for r in kept.collect()}, [r.doc_id for r in out.collect()]
        assert set(after) <= before
        if name == "near_duplicates":
            assert set(after) == {c for _, c in brute_components([(r.doc_id, r.text) for r in kept.collect()], 5).values()}
        if name == "decontaminate":
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == {r.doc_id for r in kept.collect() if not brute_contamination(r.text, items)[4]}
        if name != "mix":
            assert len(after) == len(set(after))
        kept = out
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in kept.collect())


def test_pipeline_edge_rows_and_empty_tables(spark, edge, library, small):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns, and no row at all."""
    import corpus_pipeline
    from ledgerline.llm.scratch import written
    stages = dict(corpus_pipeline.STAGES)
    wide = edge.select(*COLUMNS.replace(" long", "").replace(" string", "").split(", "), *[F.lit("x").alias(c) for c in ("key", "row_key", "epochs", "kept", "again")])
    extra = [F.lit("x").alias(c) for c in ("key", "row_key", "epochs", "kept", "again")]
    docs = wide.union(small.limit(60).select(*COLUMNS.replace(" long", "").replace(" string", "").split(", "), *extra))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF_SMALL), f"edge-{name}")
        assert out.columns == docs.columns
        kept[name], docs = [(r.doc_id, r.text) for r in out.collect()], out
    assert not [t for _, t in kept["language"] if not t or not re.search(r"[^\W\d_]", t)]  # null, empty, blank, digits
    near = kept["near_duplicates"]
    assert len(near) == len(set(near)) and set(near) <= set(kept["language"])
    assert sum(i == 6 for i, _ in near) <= 1 and sum(i == 7 for i, _ in near) <= 1
    assert set(kept["mix"]) <= set(kept["decontaminate"]) <= set(near)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in stages["token_ids"](spark, docs, SF_SMALL).collect())
    assert got == sorted((i if i is not None else -1, len(library.encode(t, add_special_tokens=False).ids) + 1) for i, t in kept["mix"])
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, wide.where("false"), SF_SMALL)
        assert none.count() == 0, name
        if name != "token_ids":
            assert none.columns == wide.columns


def test_blocks_do_not_change_features(monkeypatch):
    texts = pa.array(["Ein Wort, zwei  Wörter\nund\tmehr", "", None, "x", "abc def " * 9])
    whole = np.array(list(langid.subword_counts(texts, 1024)))
    for block in (1, 2, 3, 7, 16):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert (np.array(list(langid.subword_counts(texts, 1024))) == whole).all()


def test_text_parts(monkeypatch):
    monkeypatch.setattr(words, "PART", 10)
    texts = pa.array(["abcd", None, "efgh", "x" * 50, "", "y", "z"])
    ranges = list(words.text_parts(texts, 3))
    assert [a for a, _ in ranges] == [0, *[b for _, b in ranges[:-1]]] and ranges[-1][1] == len(texts)
    assert all(b - a == 1 or (b - a <= 3 and sum(len(t or "") for t in texts[a:b].to_pylist()) <= 10) for a, b in ranges)
    assert list(words.text_parts(texts.slice(0, 0))) == []


def test_training_returns_the_drivers_memory(spark, monkeypatch):
    """Pipeline: what the language model was trained with does not stay with the driver."""
    calls = []
    monkeypatch.setattr(langid, "return_memory", lambda: calls.append(1))
    docs = spark.createDataFrame([(i, f"das ist ein text {i}", "de") for i in range(20)] + [(i, f"this is a text {i}", "en") for i in range(20, 40)],
                                 "doc_id long, text string, lang string")
    assert langid.train(docs).languages == ["de", "en"] and calls


def test_verdicts_are_made_once(spark, monkeypatch):
    """Pipeline: the stage's last plan and its filter read one written table of verdicts."""
    made, write = [], neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, name: (made.append(name), write(df, name))[1])
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (3, None), (None, "x y"), (None, "x y"),
                                  (4, "p q r s t u"), (4, "p q r s t u")], "doc_id long, text string")
    out = neardup.drop_near_duplicates(docs)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a b c d e f g"), (3, None), (None, "x y"), (4, "p q r s t u")], key=str)
    assert made.count("verdicts") == 1 and not {"kept", "dropped"} & set(made)
