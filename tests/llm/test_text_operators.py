"""Column operators against brute force, other libraries and exact round trips."""

import random
import re
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from crashlens.llm import byte_bpe, license_scan, page_text, pii, quality_rules, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_text_statistics(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices(["a ", "b ", "cc", "é", "\n", " ", "\t", "#", "|", "\x0b", "x y z ", "\r"],
                                 k=rnd.randint(0, 80))) for _ in range(400)] + ["", " ", "a b c a b c", None]

    def brute(t):
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        lines = [x for x in t.split("\n") if re.sub(r"[\x20\x09-\x0D]+", "", x)]
        seen = Counter(zip(words, words[1:], words[2:]))
        cover = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                len(cover))

    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = df.select("i", quality_rules.text_statistics(F.col("text")).alias("s")).select("i", "s.*").collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) \
            == brute(texts[r["i"]]), texts[r["i"]]


def test_outliers_are_robust(spark):
    rnd = random.Random(2)
    plain = [" ".join(rnd.choice(["river", "stone", "a", "house", "of", "winter"]) + rnd.choice("abcdefgh") +
                      rnd.choice("klmnop") for _ in range(150)) for _ in range(180)]
    junk = [" ".join(w + " |" for w in t.split()) for t in plain[:40]]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(plain + junk)],
                                 "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_verdicts(docs).collect()}
    assert all(kept[i] for i in range(180)) and not any(kept[i] for i in range(180, 220))


def test_license_scan_against_brute_force():
    rnd, scan = random.Random(3), license_scan.Scanner()
    pool = [w for t, _ in scan.templates for w in t] + [b"cc", b"by", b"x", b"all", b"rights", b"reserved"] * 20
    sequences = [p for p, _ in scan.base + scan.templates]
    for _ in range(500):
        words = []
        while len(words) < 40:
            p = rnd.choice(sequences)
            at = rnd.randrange(len(p))
            words += p[at:at + rnd.randint(1, 12)] if rnd.random() < 0.4 else [rnd.choice(pool)]
        n, base, anchors = scan.statistics(b" ".join(words).decode())
        assert n == len(words)
        assert sorted(base) == sorted((k, i) for k, (p, _) in enumerate(scan.base)
                                      for i in range(len(words)) if words[i:i + len(p)] == p)
        longest = {}  # matching statistics: the longest template part that ends at each word
        for i in range(len(words)):
            m = 0
            while m <= i and any(words[i - m:i + 1] == s[k:k + m + 1] for s in sequences for k in range(len(s) - m)):
                m += 1
            longest[i] = m
        ends = {a + m - 1 for _, a, _, m in anchors}
        for k, a, b, m in anchors:
            assert words[a:a + m] == sequences[k][b:b + m] and longest[a + m - 1] == m
        for i, m in longest.items():
            if m >= license_scan.LEAST_MATCH and longest.get(i + 1, 0) != m + 1:
                assert i in ends


def test_license_labels():
    got = license_scan.Scanner().scan("Foo. Released under the MIT\n License. CC by-nc 4.0 ALL rights reserved")
    assert got[:4] == (14, 2, 6, 11) and got[4] == "cc-by,reserved" and got[6] == 1.0
    assert got[5] == "cc-by,cc-by-nc,mit,reserved" and "mit:1:5" in got[7].split(",")
    assert license_scan.Scanner().scan("no licence at all") == (4, 0, None, None, "", "", 0.0, "")


def test_bpe_equals_tiktoken():
    ranks = byte_bpe.read_ranks(PATH)
    codec = byte_bpe.Codec(ranks, byte_bpe.code_point_classes())
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(4)
    pool = list(" '  \n\t 　abstrevmldABS019.,!?é中🎉\x00\x85\x1c’½٣'") + ["'s", "'re", "'ll", "'ve", "  "]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 40))) for _ in range(4000)]
    for text, (ids, shown) in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == other.encode_ordinary(text) and ",".join(shown) == ",".join(map(str, ids.tolist()))
        assert codec.decode(ids) == text.encode()


def test_bpe_cuts_long_texts(monkeypatch):
    ranks = byte_bpe.read_ranks(PATH)
    codec = byte_bpe.Codec(ranks, byte_bpe.code_point_classes())
    text = "It's a  long\n\n text, we'll   cut it 42 times. " * 20
    whole = next(codec.encode([text]))[0].tolist()
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", 37)
    assert next(codec.encode([text]))[0].tolist() == whole
    assert [len(p) for p in codec.splitter.cut("x" * 500, 37)] == [500]


def test_bpe_round_trip_in_spark(spark):
    df = spark.createDataFrame([("It's 東京 🎉",), ("",), (None,)], "text string")
    ids = byte_bpe.bpe_encode(F.col("text"), PATH)
    got = df.select("text", byte_bpe.bpe_decode(ids, PATH).alias("back")).collect()
    assert all(bytes(r["back"]) == (r["text"] or "").encode() for r in got)


def test_pii_base_spans_against_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    address = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")

    def luhn(d):
        return sum((int(c) * (1 + i % 2) - 1) % 9 + 1 if int(c) * (1 + i % 2) else 0
                   for i, c in enumerate(d[::-1])) % 10 == 0

    def brute(t):
        out = [("email", *m.span()) for m in email.finditer(t)]
        out += [("ip", *m.span()) for m in address.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[ -]", "", m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
        return out

    rnd = random.Random(5)
    for _ in range(20_000):
        t = "".join(rnd.choices("ab.@@-%+ 0123456789.25.1..@x.c ()+-", k=rnd.randint(1, 40)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("9" * 6000 + ".1.1.1") == []


def test_pii_bootstraps_unseen_identifiers(spark):
    rnd = random.Random(6)
    known = [f"please wire to account 4111 1111 1111 1111 today {i}" for i in range(60)]
    unseen = [f"please wire to account ZX{rnd.randrange(10**9):09d} today" for _ in range(5)]
    other = [f"section number {rnd.randrange(10**9):09d} follows" for _ in range(40)]
    docs = spark.createDataFrame([(t,) for t in known + unseen + other], "text string")
    found = pii.fit_pii(docs)
    got = docs.select("text", pii.pii_spans(F.col("text"), found)["spans"].alias("spans")).collect()
    spans = {r["text"]: r["spans"] for r in got}
    assert all(spans[t].startswith("card:23:") for t in unseen)
    assert not any(spans[t] for t in other)
    masked = docs.select("text", pii.redact(F.col("text"), found).alias("m")).collect()
    assert {r["m"] for r in masked if r["text"] in unseen} == {"please wire to account <CARD> today"}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i, *row[1:]], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_levenshtein_automaton_against_distances():
    rnd = random.Random(7)
    terms = ["idiot", "scum", "worthless", "pathetic", "clown"]
    lexicon = toxicity.Lexicon(terms, ["lowei"])
    for _ in range(4000):
        w = list(rnd.choice([*terms, "river", "loweihaft"]))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(w) + 1)
            w[at:at + rnd.randint(0, 1)] = rnd.choices("abcdeilortw", k=rnd.randint(0, 1))
        word = "".join(w)
        if not word:
            continue
        near = [(edit_distance(word, t), t) for t in terms]
        near = [(d, t) for d, t in near if d <= next(e for n, e in toxicity.EDITS if len(t) >= n)]
        want = min(near, default=None)
        got = lexicon.look(word.encode())
        if want:
            assert got == (want[1], want[0]), word
        else:
            assert got == (("lowei", -1) if word.startswith("lowei") else None), word


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon()
    abuse = toxicity.features(lexicon, "you are an idiot and everyone knows")
    quoted = toxicity.features(lexicon, 'the old play has "an idiot" in its title')
    report = toxicity.features(lexicon, "he said idiot was a word of the past")
    assert abuse[0] > 0 and abuse[1] == 0 and abuse[5] > 0
    assert quoted[0] == report[0] == 0 and quoted[1] > 0 and report[1] > 0


def test_page_lines():
    html = ("<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li>Menu</li></ul></nav>"
            "<div class='ad'>Buy <div>now</div></div><article><header><h1>Head &amp; line</h1><p>by me</p></header>"
            "<p><b>Open<br>tags <p>two\n  words&nbsp;x</p><aside>side</aside><form><input>Go</form>"
            "<section id='comments'><p>reader</p></section></article><footer>&copy;</footer></body></html>")
    assert page_text.page_lines(html) == [(2, "Head & line"), (2, "Open tags"), (2, "two words x")]
    assert page_text.page_lines("") == [] and page_text.page_lines("<p>a<!-- x -->b") == [(0, "ab")]


def test_shared_lines_is_a_longest_common_subsequence():
    rnd = random.Random(8)
    for _ in range(400):
        a, b = (rnd.choices("abcd", k=rnd.randint(0, 12)) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        kept = [x for x, s in zip(a, page_text.shared_lines(a, b), strict=True) if s]
        assert len(kept) == best[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in kept)


def test_pages_lose_their_frame(spark):
    frame = "<p>Site name</p><p>All topics</p>{}<p>Imprint</p>"
    data = [(i, f"http://a.org/news/{i}", frame.format(f"<p>Story number {i}</p><p>Its end {i}</p>")) for i in range(6)]
    data += [(9, "http://a.org/x", "<p>Site name</p><article><p>Site name</p><p>All topics</p></article>")]
    got = {r["page_id"]: r["text"] for r in page_text.extract_pages(
        spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1)).collect()}
    assert got[9] == "Site name\nAll topics"
    assert sum(got[i] == f"Story number {i}\nIts end {i}" for i in range(6)) >= 4  # alone in its range: no neighbour


def test_shared_lines_inside_articles_go_and_copies_stay(spark):
    page = "<p>Site name</p><article><p>Notice to all readers</p>{}<p>Send us your comments</p></article>"
    data = [(10 * i + c, f"http://a.org/news/{i}?utm={c}", page.format(
        f"<p>Story number {i} about a different river</p><p>Its long end {i}, told again</p>"))
        for i in range(4) for c in range(3)]
    got = {r["page_id"]: r["text"] for r in page_text.extract_pages(spark.createDataFrame(
        data, "page_id long, url string, html string").coalesce(1)).collect()}
    own = [got[10 * i + c] == f"Story number {i} about a different river\nIts long end {i}, told again"
           for i in range(4) for c in range(3)]
    assert sum(own) >= 9  # alone in its range: no neighbour


def test_page_zone_and_wrappers():
    story = "A story of the river and its bridges, told at length. " * 6
    text = lambda html: page_text.main_text(page_text.marked_lines(html), None)
    assert text(f"<main><p>{story}</p><article><p>A teaser</p></article></main>") == story.strip()
    assert text(f"<main><p>By us</p><article><p>{story}</p></article><p>More soon</p></main>") == story.strip()
    # a wrapper with a frame's class; frames within it stay out
    wrapped = f"<nav>Menu</nav><p>{story}</p><div class='ads'>Buy</div><div class='comments'>{story * 30}</div>"
    assert text(f"<body><div class='login widget'>{wrapped}</div></body>") == story.strip()
    assert text(f"<body><div class='widget'><div id='popup'>{wrapped}</div></div></body>") == story.strip()
    assert text(f"<body><article><p>{story}</p></article><div class='widget'><p>{story}</p></div></body>") == story.strip()
    # nothing but a frame is no text
    assert text("<body><div class='cookie popup'><p>We use cookies.</p></div></body>") == ""
    assert text("<body><div class='sidebar'><a href='/'>All topics</a></div></body>") == ""


def test_headings_stay_with_their_section():
    page = lambda i: page_text.marked_lines(
        f"<article><h1>Title {i}</h1><h2>Summary</h2><p>The text of page {i}</p><h3>Related</h3><p>Read on</p></article>")
    assert page_text.main_text(page(1), page(2)) == "Title 1\nSummary\nThe text of page 1"


def test_page_query_equals_brute_force(spark):
    """All of extract_pages against pages whose text is known, at several partition counts."""
    rnd = random.Random(12)
    data, want = [], {}
    for i in range(120):
        host, own = f"h{i % 3}.org", [f"Sentence {rnd.random()} of page {i}" for _ in range(rnd.randint(2, 6))]
        frame = [f"Site {host}", "All topics of the day"], ["Imprint and contact"]
        body = "".join(f"<p>{x}</p>" for x in own)
        if i % 4 == 0:
            html = f"<p>{frame[0][0]}</p><article><h2>Summary</h2>{body}<p>Write to us</p></article>"
            want[i] = "\n".join(["Summary", *own])
        else:
            html = "".join(f"<p>{x}</p>" for x in frame[0]) + body + f"<p>{frame[1][0]}</p>"
            want[i] = "\n".join(own)
        # pages of one kind stand together by path, so each has a neighbour of its kind
        data.append((i, f"http://{host}/{'art' if i % 4 == 0 else 'plain'}/{i:03}", html))
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 5):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r["page_id"]: (r["text"], r["n_chars"]) for r in page_text.extract_pages(df).collect()}
            assert got == {i: (t, len(t)) for i, t in want.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_held_rows_spill_and_come_back():
    held = page_text._Held(most=10)
    rows = [(i, "x" * i) for i in range(30)]
    for r in rows:
        held.add(r, r[0])
    assert list(held.take()) == rows and list(held.take()) == []


def test_rare_stems_are_learned_among_many_common_words(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choices("bcdfghklmnprst", k=9)) for _ in range(3000)]
    slurs = ["".join(rnd.choices("aeiou", k=4)) + "".join(rnd.choices("wxyz", k=4)) for _ in range(200)]
    rows = [(1, " ".join(rnd.sample(words, 300) + slurs[10 * i % 200:10 * i % 200 + 10])) for i in range(200)]
    rows += [(0, " ".join(rnd.sample(words, 300))) for i in range(1100)]
    learned = set(toxicity.learned_stems(spark.createDataFrame(rows, "label int, text string")))
    assert all(any(w.startswith(x) for x in learned) for w in slurs)


def test_learned_terms_have_edits_and_context():
    lexicon = toxicity.Lexicon(stems=["grobn"], learned=["grobnikar"])
    assert lexicon.look(b"grpbnikar") == ("grobnikar", 1) and lexicon.look(b"grobnoid") == ("grobn", -1)
    assert lexicon.look(b"scvm") == ("scum", 1)
    abuse = toxicity.features(lexicon, "you are a grobnikar and everyone knows")
    stem = toxicity.features(lexicon, "you are a grobnoid and everyone knows")
    quoted = toxicity.features(lexicon, 'the old play has "a grobnikar" in its title')
    typo = toxicity.features(lexicon, "you are a grpbnikar and everyone knows")
    short = toxicity.features(lexicon, "you are scvm and everyone knows")
    assert abuse[4] > 0 and abuse[5] > 0 and abuse[9] == 0 and abuse[0] == 0
    assert stem[4] > 0 and stem[5] > 0 and quoted[4] == 0 and quoted[9] > 0 and quoted[5] == 0
    assert typo[10] > 0 and typo[5] > 0 and short[11] > 0 and sum(map(bool, short)) == 1


def test_pii_patterns_of_a_small_source_survive_a_hot_one(spark, monkeypatch):
    rows = [("card", "L|hot line", 0.99, 4_000_000), ("card", "L|to account", 0.95, 500), ("card", "L|seen once", 0.99, 1)]
    scored = spark.createDataFrame(rows, "kind string, pattern string, confidence double, n_seeds long")
    known = pii.confident_patterns(scored)
    assert known == {"L|hot line": ("card", 0.99), "L|to account": ("card", 0.95)}
    docs = spark.createDataFrame([(0, "wire to account ZX123456789 now"), (1, "no"), (2, None),
                                  (3, "wire to account ZX123456789 now")], "i long, text string")
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 1)
    many = pii.confident_patterns(scored)
    assert not isinstance(many, dict)
    for call, column in ((pii.with_spans, "_r"), (pii.redacted, "text")):
        few, joined = ({r["i"]: r[column] for r in call(docs, k).collect()} for k in (known, many))
        assert few == joined
    assert joined[0] == joined[3] == "wire to account <CARD> now" and joined[2] is None


def test_pii_finds_grouped_short_and_digitless_identifiers():
    known = {"L|call me": ("phone", 0.9), "L|my iban": ("card", 0.9), "L|account no": ("card", 0.9),
             "~L|my password:": ("secret", 0.95)}

    def found(t):
        return [(k, t[a:b]) for k, a, b in pii.all_spans(t, known)]

    assert found("please call me 0171 234 5678 today") == [("phone", "0171 234 5678")]
    assert found("please call me 0171-234 5678.") == [("phone", "0171-234 5678")]
    assert found("my iban DE89 3704 0044 0532 0130 00 is") == [("card", "DE89 3704 0044 0532 0130 00")]
    assert found("account no 123456, thanks") == [("card", "123456")]
    assert found("my password: horsebattery is") == [("secret", "horsebattery")]
    assert found("nothing 0171 234 5678 here") == []


def test_pages_at_the_edge_of_a_range_see_their_neighbours(spark):
    page = "<p>Site name</p><p>All topics</p>{}<p>Imprint</p>"
    data = [(10 * i + c, f"http://a.org/news/{i}", page.format(f"<p>Story number {i}</p><p>Its end {i}</p>"))
            for i in range(12) for c in range(4 if i % 5 == 2 else 1)]
    docs = spark.createDataFrame(data, "page_id long, url string, html string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 3, 7, 30):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got = {r["page_id"]: r["text"] for r in page_text.extract_pages(docs).collect()}
            assert got == {i: f"Story number {i // 10}\nIts end {i // 10}" for i, _, _ in data}, n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_class_names_count_whole_and_long_elements_end():
    assert page_text.page_lines('<article class="post has-sidebar comments"><div class="entry-header"><h1>Head</h1></div>'
                                '<p>Text</p><div class="cookie-banner">ad</div></article>') == [(2, "Head"), (2, "Text")]
    assert page_text.page_lines('<div class="content no-sidebar"><p>Text</p></div>') == [(0, "Text")]
    assert page_text.page_lines("<p>a</p><svg>" + "<text>x</text>" * 90_000 + "</svg><p>b</p>") == [(0, "a"), (0, "b")]
