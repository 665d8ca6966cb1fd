"""Operators on pages: exact round trips, brute force and defined cases."""

import hashlib
import re

import pytest

from conftest import SF_ORACLE
from ledgerline.llm import html_extract, url_filter, warc_store
from ledgerline.llm.queries import oracle_sql, queries
from ledgerline.session import shared_folder
from oracle import compare, duck

PAGES = "page_id long, url string, html string, key string, host string, digest string"


def pages(spark, *cells):
    return spark.createDataFrame([(*c, "x", "y", "z") for c in cells], PAGES)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(queries()[name](spark, SF_ORACLE), duck(SF_ORACLE), oracle_sql()[name])
    assert res["match"], res


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 60
    p = pages(spark, (5, "http://a/x", big), (3, "http://a/y", big), (9, None, big), (None, "http://a/z", big), (4, "u", None),
              (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (3, "http://a/y", big))
    folder = shared_folder(spark, "t")
    warc_store.write_archive(p, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    got = sorted((str(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in warc_store.read_records(spark, folder).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = sorted([("5", 120, sha(big), "revisit", 3), ("3", 120, sha(big), "response", None), ("3", 120, sha(big), "response", None),
                   ("9", 120, sha(big), "revisit", 3), ("None", 120, sha(big), "revisit", 3), ("4", 0, sha(""), "response", None),
                   ("6", 0, sha(""), "response", None), ("7", 5, sha("short"), "response", None), ("8", 5, sha("short"), "response", None)],
                  key=str)
    assert sorted(got, key=str) == want
    warc_store.write_warc(spark, folder, str(tmp_path / "out"))
    data = b"".join(f.read_bytes() for f in (tmp_path / "out").glob("part-*"))
    seen = 0
    while data:  # by Content-Length, as a WARC reader does
        head, _, rest = data.partition(b"\r\n\r\n")
        n = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert rest[n:n + 4] == b"\r\n\r\n"
        data, seen = rest[n + 4:], seen + 1
    assert seen == 9
    empty = shared_folder(spark, "t")
    warc_store.write_archive(p.limit(0), empty)
    assert warc_store.read_records(spark, empty).count() == 0


def test_warc_records_are_read_without_shuffling_payloads(spark):
    folder = shared_folder(spark, "t")
    warc_store.write_archive(pages(spark, (1, "http://a/x", "a" * 200), (2, "http://a/y", "a" * 200)), folder)
    plan = warc_store.read_records(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    above, joined, below = plan.partition("Join ")
    assert joined and not re.search(r"\bpayload#", above) and re.search(r"\bpayload#", below)


def test_url_filter(spark):
    e = [url_filter.Entry("com", "/", "allow"), url_filter.Entry("example.com", "/en/", "block"),
         url_filter.Entry("bad.org", "", "block", listed=True), url_filter.Entry("bad.org", "/ok/", "allow")]
    p = pages(spark, (1, "http://WWW.Example.com/en/x?q#f", ""), (2, "http://a.com/de", ""), (3, None, ""), (4, "no scheme", ""),
              (5, "x://sub.BAD.org", ""), (6, "x://bad.org/ok/1", ""), (7, "x://notbad.org/", ""), (8, "", ""))
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(p, url_filter.build_index(spark, e)).collect()}
    assert got == {1: ("www.example.com", "/en/x", "example.com/en/", "block"), 2: ("a.com", "/de", "com/", "allow"),
                   3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("sub.bad.org", "", None, "block"),
                   6: ("bad.org", "/ok/1", "bad.org/ok/", "allow"), 7: ("notbad.org", "/", None, "allow"), 8: ("", "", None, "allow")}
    none = url_filter.judge_urls(p, url_filter.build_index(spark, [])).collect()
    assert {r.verdict for r in none} == {"allow"}
    assert url_filter.judge_urls(p.limit(0), url_filter.build_index(spark, e)).count() == 0


def test_url_probe_survives_digest_collisions():
    import numpy as np

    digests, names = np.array([5, 7, 7, 7, 9], np.uint64), np.array(["a", "b", "c", "d", "e"], object)
    texts = np.array(["d", "x", "e", "a", "q"], object)
    assert list(url_filter.probe(digests, names, np.array([7, 7, 9, 5, 11], np.uint64), texts)) == [3, -1, 4, 0, -1]


def test_html_extract(spark):
    menu = "<div class=box><p>home news sport weather travel food music books films maps help about</p></div>"
    page = lambda t: f"<html><body>{menu}<p>{t}</p></body></html>"
    art = "<nav>menu</nav><header>top</header><article><h1>T &amp; x</h1><p>one\n <b>two<br>x<p>three</article><aside>s</aside><footer>f"
    p = pages(spark, *[(i, f"http://h/{i}", page(" ".join(f"w{i}x{k}" for k in range(6)))) for i in range(6)],
              (10, "http://k/1", art), (11, None, None), (12, "http://k/2", ""), (12, "http://k/2", ""),
              (13, "http://k/3", "<article><p>a</p><section class=comments><p>reader</p></section></article><script>x<"))
    got = {r.page_id: r for r in html_extract.extract_pages(p).collect()}
    for i in range(6):
        assert got[i].text == " ".join(f"w{i}x{k}" for k in range(6)) and got[i].n_repeated == 12
    assert got[10].text == "T & x\none two x\nthree" and got[13].text == "a"
    assert got[11].text == "" and got[12].n_chars == 0
    assert html_extract.extract_pages(p).count() == 11
    assert html_extract.extract_pages(p.limit(0)).count() == 0


def test_pieces_of_class_words_and_runs_are_decided_by_repeats():
    menu = "home news sport weather travel food music books films maps"
    own = lambda i, n=9: " ".join(f"w{i}x{k}" for k in range(n))
    boxes = ["<div class='content no-sidebar'><p>{}</p></div>", "<div id='layout-header-fixed'><p>{}</p></div>"]
    pages = [(f"p{i}", f"<body><p>{menu} {own(i)}</p>" + boxes[i % 2].format(own(100 + i))) for i in range(6)]
    got = html_extract.extract_host(pages)
    assert got == [(f"{own(i)}\n{own(100 + i)}", 10) for i in range(6)]
    pages = [(f"p{i}", f"<article><div class='article-header'><h1>{own(i, 3)}</h1><p>{menu}</p></div><p>{own(50 + i)}</p></article>"
              f"<div class='page-teaser'>{own(70 + i)}</div>") for i in range(6)]
    assert html_extract.extract_host(pages) == [(f"{own(i, 3)}\n{own(50 + i)}", 10) for i in range(6)]


def test_blocks_of_an_article_that_stand_in_most_articles_of_a_host_are_cut(spark):
    """A box without a listed word goes; passages that few articles share, short articles' lines and copies stay."""
    own = lambda i, n=30: " ".join(f"w{i}x{k}" for k in range(n))
    box = "read more of our best stories every day right here at home"
    shared = " ".join(f"quoted{k}" for k in range(20))
    art = lambda *blocks: "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    cells = [(i, f"http://h/{i}", art(own(i), box, own(100 + i, 12))) for i in range(20)]
    cells += [(100 + i, f"http://q/{i}", art(own(i), *([shared] if i < 4 else []))) for i in range(8)]
    cells += [(200 + i, f"http://c/{i}", art(own(1), own(2))) for i in range(9)]  # equal articles
    cells += [(300 + i, f"http://n/{i}", art(own(3), own(4, 9) + f" changed{i}")) for i in range(9)]  # near copies
    cells += [(400 + i, f"http://s/{i}", art(own(i), box)) for i in range(4)]  # few articles
    got = {r.page_id: (r.text, r.n_repeated) for r in html_extract.extract_pages(pages(spark, *cells)).collect()}
    for i in range(20):
        assert got[i] == (f"{own(i)}\n{own(100 + i, 12)}", 12)
    for i in range(8):
        assert got[100 + i][0] == own(i) + ("\n" + shared if i < 4 else "")
    for i in range(9):
        assert got[200 + i][0] == f"{own(1)}\n{own(2)}" and got[300 + i][0] == f"{own(3)}\n{own(4, 9)} changed{i}"
    for i in range(4):
        assert got[400 + i][0] == f"{own(i)}\n{box}"


def test_extraction_is_the_same_on_any_partitioning(spark):
    """A line on every page of a host is cut whatever the partitions; also on pages of 4 MB, and on a host of several groups."""
    line = "home news sport weather travel food music books films maps"
    own = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    page = lambda i, n: f"<body><p>{line}</p><p>{own(i, n)}</p></body>"
    cells = [(i, f"http://h/{i}", page(i, 40)) for i in range(8)] + [(100 + i, f"http://big/{i}", page(i, 400_000)) for i in range(3)]
    p = pages(spark, *cells)
    seen = []
    for partitions in (1, 8, 211):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            seen.append({r.page_id: (r.n_chars, hash(r.text), r.n_repeated) for r in html_extract.extract_pages(p.repartition(partitions % 5 + 1)).collect()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert seen[0] == seen[1] == seen[2]
    assert all(seen[0][i] == (len(t), hash(t), 10) for i, t in [(k[0], own(k[0] % 100, 40 if k[0] < 100 else 400_000)) for k in cells])


def test_a_host_of_several_groups(spark, monkeypatch):
    line = "home news sport weather travel food music books films maps"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(20))
    monkeypatch.setattr(html_extract, "GROUP_BYTES", 1 << 13)
    p = pages(spark, *[(i, f"http://h/{i}", f"<body><p>{line}</p><p>{own(i)}</p></body>") for i in range(300)])
    got = {r.page_id: r.text for r in html_extract.extract_pages(p).collect()}
    assert got == {i: own(i) for i in range(300)}


def test_repeats_count_over_the_whole_host_of_several_groups(spark, monkeypatch):
    """A passage on two pages of one group of many is no repeat, one on few pages of each group is."""
    own = lambda i, n=20: " ".join(f"w{i}x{k}" for k in range(n))
    twice = " ".join(f"twice{k}" for k in range(12))
    cells = [(i, f"http://two/{i}", f"<body><p>{own(i, 500)}</p>" + (f"<p>{twice}</p>" if i < 2 else "") + "</body>") for i in range(4)]
    cells += [(100 + i, f"http://many/{i}", f"<body><p>{own(i)}</p>" + (f"<p>{own(900 + i // 2, 12)}</p>" if i < 60 else "") + "</body>")
              for i in range(80)]
    for size in (1 << 20, 1 << 10):
        monkeypatch.setattr(html_extract, "GROUP_BYTES", size)
        got = {r.page_id: (r.text, r.n_repeated) for r in html_extract.extract_pages(pages(spark, *cells)).collect()}
        assert [got[i] for i in range(4)] == [(own(i, 500), 12 * (i < 2)) for i in range(4)]
        for i in range(80):
            assert got[100 + i] == (own(i) + (f"\n{own(900 + i // 2, 12)}" if i < 60 else ""), 0)


def test_hosts_of_several_groups_give_the_texts_of_one_array(spark, monkeypatch):
    """Against all pages of a host at once: passages of every share, copied articles, pages that repeat and differ, null keys."""
    import random

    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(300)}"
    passages = [" ".join(word() for _ in range(rng.randrange(6, 25))) for _ in range(30)]
    articles = [[" ".join(word() for _ in range(rng.randrange(3, 40))) for _ in range(rng.randrange(1, 4))] for _ in range(25)]
    cells = []
    box = " ".join(f"box{k}" for k in range(10))
    for host, n, plain in (("a", 160, 5), ("b", 160, 20), ("c", 12, 1)):  # few or many articles without the box, copied often
        for i in range(n):
            j = rng.randrange(25 if rng.random() < 0.3 else plain) if i < 0.6 * n else 25
            out = [f"<p>{p}</p>" for k, p in enumerate(passages) if rng.random() < 0.012 * k]
            held = [*articles[j]] if j < 25 else [" ".join(word() for _ in range(30))]
            if j >= plain:
                held.append(box)
            kind = rng.randrange(4)
            html = "".join(out) if kind == 0 else f"<div class='x-header'>{out[0] if out else word()}</div><nav>{passages[3]}</nav>" \
                + "<article>" + "".join(f"<p>{t}</p>" for t in held) + "</article>"
            key = None if rng.random() < 0.05 else i if rng.random() < 0.8 else rng.randrange(n)
            cells.append((key, f"http://{host}/{0 if key is None else key}", html if rng.random() > 0.03 else None))
    cells += rng.sample(cells, 15)
    rng.shuffle(cells)
    want = []
    for host in "abc":
        at = [(k, u, h) for k, u, h in cells if u.startswith(f"http://{host}/")]
        want += [(k, u, *x) for (k, u, _), x in zip(at, html_extract.extract_host([((k, u), h) for k, u, h in at]))]
    assert len({x[3] for x in want}) > 10
    boxes = [(u[7], box in text) for (_, u, h), (_, _, text, _) in zip(sorted(cells, key=lambda c: c[1][7]), want) if h and box in h]
    assert boxes.count(("a", True)) < 9 < 40 < boxes.count(("a", False)) and boxes.count(("b", False)) < 9 < 40 < boxes.count(("b", True))
    cut = lambda rows: sorted(((r[0], r[1], r[2], r[-1]) for r in rows), key=str)
    for size in (1 << 10, 1 << 12, 1 << 14):
        monkeypatch.setattr(html_extract, "GROUP_BYTES", size)
        assert cut(html_extract.extract_pages(pages(spark, *cells)).collect()) == cut(want)


def test_a_large_host_is_read_and_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "GROUP_BYTES", 1 << 10)
    got = html_extract.extract_pages(pages(spark, *[(i, f"http://h/{i}", f"<p>w{i} {'x ' * 50}</p>") for i in range(60)]))
    assert len(got.collect()) == 60
    text = got._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert len(re.findall(r"MapInArrow _read", text)) == 2  # hosts of one group and of several


def test_runs_are_found_like_suffixes():
    import numpy as np

    rng = np.random.default_rng(2)
    stream = rng.integers(0, 3, 3000)
    stream[rng.integers(0, 3000, 40)] = -1 - np.arange(40)
    run = html_extract.RUN
    runs = np.unique(np.concatenate([rng.integers(0, 3, (50, run)), [stream[i:i + run] for i in range(0, 900, 9)]]), axis=0)
    runs = runs[(runs >= 0).all(axis=1)]
    of = {tuple(r): k for k, r in enumerate(runs)}
    want = [of.get(tuple(stream[i:i + run]), -1) for i in range(3000)]
    assert list(html_extract.find_runs(stream, runs)) == want and max(want) > 50


def test_covered_tokens_match_brute_force():
    import numpy as np

    rng = np.random.default_rng(1)
    run = html_extract.RUN
    common = list(range(100, 100 + run + 3))
    stream, page = [], []
    for k in range(7):
        tokens = list(rng.integers(0, 40, 30)) + (common if k % 2 else []) + list(rng.integers(0, 40, 10))
        stream += [int(x) for x in tokens] + [-1 - k]
        page += [k] * (len(tokens) + 1)
    where = {}
    for i in range(len(stream) - run + 1):
        where.setdefault(tuple(stream[i:i + run]), []).append(i)
    want = np.zeros(len(stream), bool)
    for places in where.values():
        if len({page[i] for i in places}) >= 2:
            for i in places:
                want[i:i + run] = True
    assert (html_extract.covered_tokens(np.array(stream), np.array(page), 7) == want).all() and want.any()
