"""Decontamination, secrets, toxicity, line rules and URL templates on small cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import decontam, lines, secrets, toxicity, urls
from tests.llm.cases import empty_documents, odd_documents


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 9))) for _ in range(n))


def edits(a, b):
    """Least edits between all of ``a`` and any stretch of ``b``."""
    row = np.zeros(len(b) + 1, int)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = np.array(new)
    return row.min()


def test_regions_against_plain_alignment():
    rng = random.Random(6)
    item = words(rng, 40)
    found = decontam.Patterns([(3, item)], 8, 60, 12)
    for trial in range(60):
        start = rng.randrange(0, len(item) - 60)
        piece = list(item[start : start + 60])
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(piece))
            piece[at : at + 1] = rng.choice([[], ["z"], [piece[at], "z"]])
        text = words(rng, 12) + "".join(piece) + words(rng, 12)
        data = np.frombuffer(text.encode(), np.uint8)
        got = {start for _, e, start, _ in ((0, *m[1:]) for m in found.matches(data))}
        want = [edits(t.tobytes().decode(), text) <= found.allowed[i] for i, t in enumerate(found.text)]
        assert bool(got) == any(want)
        if any(want):
            assert found.dense(data, np.array([0, len(data)])).tolist() == [0]


def test_passages(spark):
    rng = random.Random(7)
    items = [words(rng, 30) for _ in range(4)] + [None, "", "tiny"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [words(rng, 50) + items[0].upper() + words(rng, 9), words(rng, 200), items[1].replace(" ", "\n"), None, "", items[2][:95], items[2][:40]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.passages(docs, bench).collect()}
    assert got == {(0, 0), (2, 1), (5, 2)}
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6]
    odd = odd_documents(spark)
    assert decontam.drop_contaminated(odd, bench).count() == odd.count()
    assert decontam.passages(empty_documents(spark), bench).count() == 0
    assert decontam.passages(odd, bench.where("false")).count() == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(secrets.PATTERNS.items()):
        for m in re.finditer(pattern, text, re.IGNORECASE | re.ASCII if kind == "assign" else 0):
            if len(m[2] if kind == "assign" else m[0]) >= secrets.LEAST[kind]:
                out.append((m.start(), order, m.end()))
    return sorted(out)


def test_secrets(spark):
    rng = random.Random(8)
    texts = [words(rng, 30) for _ in range(60)]
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    for i in range(0, 30, 3):
        texts[i] += f" Password = '{hexes(12)}' and AKIA{hexes(20).upper()} é {hexes(30)} " + words(rng, 5)
    texts += [None, "", "password=abc token: abcdefg", "AKIAAKIA short"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kind string")
    got = secrets.find(docs, secrets.train(docs)).collect()
    for r in got:
        base = [(s.start, list(secrets.PATTERNS).index(s.kind), s.end) for s in r.secrets if s.kind != "field"]
        assert base == plain_spans(r.text or "")
        spans = sorted((s.start, s.end) for s in r.secrets)
        assert all(0 <= a < b <= len(r.text) for a, b in spans)
    masked = secrets.mask_secrets(docs)
    assert masked.columns == docs.columns
    assert all(not plain_spans((r.text or "").replace("[SECRET]", "")) for r in masked.collect())
    assert secrets.mask_secrets(odd_documents(spark)).count() == odd_documents(spark).count()
    assert secrets.mask_secrets(empty_documents(spark)).count() == 0


def test_decode_with_certain_tokens_is_exact():
    rng = np.random.default_rng(9)
    for _ in range(200):
        pairs = rng.normal(size=(3, 3))
        field = secrets.Field(*[np.zeros((1, 3))] * 4, pairs)
        scores = rng.normal(size=(rng.integers(1, 9), 3)) * 4
        best = max(np.ndindex(*[3] * len(scores)), key=lambda p: sum(scores[i, t] for i, t in enumerate(p)) + sum(pairs[a, b] for a, b in zip(p, p[1:])))
        assert field.decode(scores).tolist() == list(best)


def test_toxicity(spark):
    rng = random.Random(10)
    bad = ["vile", "nasty", "horrid", "grim"]
    rows = []
    for i in range(300):
        text = words(rng, 60)
        if i % 5 == 0:
            text += " " + " ".join(rng.choice(bad) for _ in range(3)) + " " + words(rng, 9)
        rows.append((i, text, int(i % 5 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(300, None), (301, ""), (None, "vile nasty")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3], "doc_id long, toxic int")
    index = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert sum(got[i].predicted == t for i, _, t in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values()) and got[300].predicted == got[301].predicted == 0
    # the nearest examples are those of all cosines
    dense = np.zeros((len(index.label), len(index.vocabulary)))
    for t in range(len(index.vocabulary)):
        own = slice(index.first[t], index.first[t + 1])
        dense[index.example[own], t] = index.value[own]
    for _ in range(50):
        terms = np.sort(np.array(rng.sample(range(len(index.vocabulary)), min(3, len(index.vocabulary)))))
        vector = index.vector(terms, np.ones(len(terms)))
        cosine = dense[:, terms] @ vector
        _, found = index.nearest(terms, vector, 7)
        assert found == pytest.approx(np.sort(cosine[cosine > 0])[::-1][:7])
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert toxicity.score(empty_documents(spark), toxicity.train(empty_documents(spark), labels.where("false"))).count() == 0
    assert toxicity.score(odd_documents(spark), index).count() == odd_documents(spark).count()


def test_line_rules(spark):
    rng = random.Random(11)
    rows = [(i, "\n".join([words(rng, 20), "Shared  LINE of the host", words(rng, 20)]), "a") for i in range(30)]
    rows += [(100 + i, "shared line of the host\n" * 3 + f"few own words {i}", "a") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in lines.line_rules(docs, share=0.0).collect()}
    assert sum(r.removed_words == 0 for r in got.values()) == 1
    assert all(got[i].kept for i in range(30)) and not any(got[i].kept for i in (100, 101, 102))
    odd = odd_documents(spark)
    assert lines.line_rules(odd).count() == odd.count() and lines.line_rules(empty_documents(spark)).count() == 0


def test_frequent_lines_leave_the_text(spark):
    own = [f"Own  first {i}\n\n  Shared LINE\t of the host \nown last {i}\n" for i in range(25)]
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(own)] + [(25, None, "a"), (26, own[0], "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in lines.line_rules(docs).collect()}
    cut = [i for i in range(25) if got[i].text != own[i]]
    assert len(cut) == 24 and all(got[i].text == f"Own  first {i}\n\nown last {i}\n" and got[i].removed_words == 5 for i in cut)
    assert got[25].text is None and got[26].text == own[0] and got[26].removed_words == 0


def test_line_limit_at_any_size_of_host(spark):
    """A line in 21 texts is frequent in a host of 21 and of 6000; a fifth of a small host is enough."""
    rng = random.Random(12)
    for n, shared, gone in ((21, 21, 20), (6000, 21, 20), (6000, 20, 0), (10, 6, 5), (100, 6, 0)):
        rows = [(i, words(rng, 15) + ("\nSHARED by some" if i < shared else ""), "a") for i in range(n)]
        got = lines.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
        assert got.where("removed_words = 3").count() == gone and got.where("removed_words > 0").count() == gone


def test_counts_follow_the_text_returned(spark):
    docs = odd_documents(spark).unionByName(odd_documents(spark, 2)).withColumn("source", F.lit("one"))
    for r in lines.line_rules(docs, most=2, few=1).collect():
        assert r.removed_words == r.n_words - len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))


def test_no_text_below_an_exchange(spark, tmp_path):
    from framewright.llm import queries

    odd_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.QUERIES["op8_line_frequency"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan()
    found, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        if "Join" in node.nodeName():
            found += [a for i in range(node.children().size()) for a in node.children().apply(i).output().mkString(",").split(",")]
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert found and not any(a.startswith("text#") for a in found)


def test_urls(spark):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    rows = [(0, None), (1, "no host"), (2, "http://A.Example.NET/en/1?x"), (3, "http://x.net"), (4, "https://example.com/de/a#b"), (5, "http://notexample.com/de/a"), (6, "http://x.org/fr/é"), (7, "a://b/c://d")]
    rows += [(100 + i, f"http://mixed.com/{'spam' if i % 2 else 'news'}/{i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(0, 200, 3)], "page_id long, bad int")
    got = {r.page_id: r for r in urls.judge(pages, labels, rules).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(2, 5)] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("x.net", "", None, "allow"),
        ("example.com", "/de/a", "example.com/de/", "block"),
    ]
    assert got[0].host == got[1].host == "" and got[5].rule is None and got[6].rule == "org/fr/" and (got[7].host, got[7].path) == ("b", "/c://d")
    assert all(got[100 + i].verdict == ("block" if i % 2 else "allow") for i in range(200))
    assert urls.judge(pages.where("false"), labels, rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, labels.where("false"), {}).collect()} == {"allow"}


def test_digest_of_no_span():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def plain_templates(pages, labels, least, depth, z, strength, limit):
    """The verdict of every url: the tree and its merging, host by host, in plain Python."""
    verdicts = {}
    every = [labels[k] for k, _ in pages if k in labels]
    base = sum(every) / len(every) if every else 0.0
    by_host = {}
    for k, url in pages:
        host, _, path = url.partition("://")[2].partition("/")
        by_host.setdefault(host, []).append((k, path.split("/", depth - 1)))
    for rows in by_host.values():
        template = {k: [] for k, _ in rows}
        for level in range(depth):
            counts = {}
            for k, parts in rows:
                if level < len(parts):
                    at = (tuple(template[k]), parts[level])
                    counts[at] = counts.get(at, 0) + 1
            for k, parts in rows:
                if level < len(parts):
                    template[k] = template[k] + [parts[level] if counts[tuple(template[k]), parts[level]] >= least else "*"]
        final = {k: tuple(t) for k, t in template.items()}
        for _ in range(max(len(t) for t in final.values())):
            n, bad, parent = {}, {}, {}
            for k, t in final.items():
                last = max((i for i, x in enumerate(t) if x not in ("*", "")), default=None)
                parent[t] = t if last is None else (*t[:last], "*", *t[last + 1 :])
                n[t] = n.get(t, 0) + (k in labels)
                bad[t] = bad.get(t, 0) + labels.get(k, 0)
            all_n, all_bad = {}, {}
            for t, p in parent.items():
                all_n[p], all_bad[p] = all_n.get(p, 0) + n[t], all_bad.get(p, 0) + bad[t]
            moved = {}
            for t, p in parent.items():
                rest = all_n.get(p, 0) - n[t]
                apart = False
                if p != t and n[t] >= least and rest >= least:
                    rate = all_bad[p] / all_n[p]
                    spread = (rate * (1 - rate) * (1 / n[t] + 1 / rest)) ** 0.5
                    apart = abs(bad[t] / n[t] - (all_bad[p] - bad[t]) / rest) > z * spread
                moved[t] = t if apart else p
            final = {k: moved[t] for k, t in final.items()}
        own = [labels[k] for k in final if k in labels]
        of_host = (sum(own) + strength * base) / (len(own) + strength)
        for t in set(final.values()):
            those = [k for k, x in final.items() if x == t]
            known = [labels[k] for k in those if k in labels]
            purity = (sum(known) + strength * of_host) / (len(known) + strength)
            verdicts |= dict.fromkeys(those, "block" if purity > limit else "allow")
    return verdicts


def test_small_section_of_a_large_host(spark):
    """One bad section of forty is blocked on a host where it has a fortieth of the pages."""
    rows = [(i, f"http://a.com/s{i % 40}/{i}") for i in range(4000)]
    labels = [(i, int(i % 40 == 7)) for i in range(4000)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), {}).collect()
    assert all(r.verdict == ("block" if r.page_id % 40 == 7 else "allow") for r in got)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_templates_against_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    rows, labels = [], {}
    for i in range(1500):
        section, kind = rng.choice(["news", "spam", "blog", "shop"]), rng.choice(["a", "b", f"u{rng.randint(0, 400)}"])
        rows.append((i, f"http://h{i % 3}.com/{section}/{kind}/{rng.randint(0, 10**6)}" + ("/x/y" if rng.random() < 0.1 else "")))
        if rng.random() < 0.5:
            labels[i] = int(rng.random() < {"spam": 0.95, "shop": 0.6 if kind == "a" else 0.1}.get(section, 0.05))
    want = plain_templates(rows, labels, 10, 4, 1.96, 10.0, 0.5)
    frames = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(list(labels.items()), "page_id long, bad int")
    got = {r.page_id: r.verdict for r in urls.judge(*frames, {}, depth=4).collect()}
    assert got == want and set(got.values()) == {"block", "allow"}


def test_masking_beside_a_column_named_secrets(spark):
    docs = spark.createDataFrame([(i, f"password: hunter2secret{i}", "mine") for i in range(5)], "doc_id long, text string, secrets string")
    got = secrets.mask_secrets(docs)
    assert got.columns == docs.columns and all(r.secrets == "mine" and "hunter2" not in r.text for r in got.collect())
    assert secrets.find(docs, secrets.train(docs)).columns == ["doc_id", "text", "secrets"]


def test_sample_of_equal_rows(spark, monkeypatch):
    """Many copies of a row count once, and a long text gives a bounded number of parts."""
    given = []
    monkeypatch.setattr(secrets, "fit", given.append)
    docs = spark.createDataFrame([(1, "plain words here")] * 3000 + [(2, "w " * 400_000)], "doc_id long, text string")
    secrets.train(docs, sample=5, reach=8, apart=400)
    assert len(given[0]) <= 1 + 51 * (5 + 6)  # at regular places, and around words that look odd


def test_evidence_names_neighbours(spark):
    """Keys and cosines of the nearest examples, against all examples in plain Python."""
    rng = random.Random(5)
    rows = [(i, words(rng, 20) + (" vile grub" if i % 4 == 0 else "")) for i in range(200)] + [(0, "another text of key nought")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    index = toxicity.train(docs, labels, k=5)
    assert len(index.keys) <= 200
    got = toxicity.score(docs.withColumn("evidence", F.lit(1)), index, k=5).collect()
    for r in got:
        near = [int(e.key) for e in r.evidence]
        assert r.predicted == int("vile" in r.text) and bool(near) == ("vile" in r.text)
        assert all(i % 4 == 0 for i in near) and [e.cosine for e in r.evidence] == sorted((e.cosine for e in r.evidence), reverse=True)


def test_marginals():
    """Against all tag sequences, with windows of different lengths."""
    rng = np.random.default_rng(4)
    scores, pairs = rng.normal(size=(5, 4, 3)) * 3, rng.normal(size=(3, 3)) * 2
    mask = np.arange(4) < np.array([4, 3, 1, 2, 4])[:, None]
    one, two = secrets.marginals(scores, mask, pairs)
    for w in range(5):
        n = mask[w].sum()
        want, want_two, total = np.zeros((4, 3)), np.zeros((3, 3, 3)), 0.0
        for path in np.ndindex(*[3] * n):
            p = np.exp(sum(scores[w, i, t] for i, t in enumerate(path)) + sum(pairs[a, b] for a, b in zip(path, path[1:])))
            total += p
            for i, t in enumerate(path):
                want[i, t] += p
            for i, (a, b) in enumerate(zip(path, path[1:])):
                want_two[i, a, b] += p
        assert np.allclose(one[w], want / total) and np.allclose(two[w], want_two / total)


def test_field_finds_secrets_that_no_pattern_matches(spark):
    """Learnt from texts with matches of the fixed patterns alone; e-mail addresses, numbers and long words are no secrets."""
    rng = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda n, of=letters: "".join(rng.choice(of) for _ in range(n))

    def plain():
        odd = [f"{words(rng, 1)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", str(rng.randrange(10**15)), words(rng, 3).replace(" ", "")]
        return f"{words(rng, 30)} {rng.choice(odd)} {words(rng, 30)}"

    forms = [lambda: "ghp_" + some(36), lambda: f'pwd = "{some(20)}"', lambda: "credential: " + some(24), lambda: "Bearer " + some(40)]
    known = [(i, f"{plain()} token = \"{some(40, '0123456789abcdef')}\" {plain()}") for i in range(300)] + [(300 + i, plain()) for i in range(300)]
    planted = [(1000 + i, f"{plain()} {rng.choice(forms)()} {plain()}") for i in range(100)]
    clean = [(2000 + i, plain()) for i in range(200)]
    assert not any(plain_spans(t) for _, t in planted + clean)
    schema = "doc_id long, text string"
    field = secrets.train(spark.createDataFrame(known, schema))
    found = {r.doc_id for r in secrets.find(spark.createDataFrame(planted + clean, schema), field).collect() if r.secrets}
    assert len([i for i in found if i < 2000]) >= 90 and len([i for i in found if i >= 2000]) <= 4
