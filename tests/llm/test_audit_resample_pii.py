"""Divergence audit, resampling and personal data against SQL, brute force and held-out spans."""
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import pytest

from otif.llm import divergence, pii, resample
from otif.llm.common import Staging
from otif.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_resampling"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours = QUERIES[name](spark, SF)
    wanted = con.execute(ORACLE[name])
    assert ours.columns == [d[0] for d in wanted.description]
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(wanted.fetchall(), key=str)


# ---- op11


def audit_by_hand(rows, min_docs=3, top=200):
    """rows: (lang, source, text)."""
    count, in_docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        count[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        total = Counter({t: sum(count[lang, s][t] for s in sources) for t in kept})

        def p(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept))

        for s in sources:
            c = count[lang, s]
            pairs = [(o, sum((p(c, t) - (q := p(count[lang, o], t))) ** 2 // q for t in kept)) for o in sources - {s}]
            terms = [(t, (p(c, t) - q) ** 2 // q) for t in kept if c[t] and p(c, t) > (q := p(total, t))]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_audit_of_odd_rows(spark):
    rnd = random.Random(4)
    words = ["the", "The", "été", "a", "zz9zz", "x-y", "Ünder", "same", "o'clock"]
    rows = [(rnd.choice(["en", None, "", "de"]), rnd.choice(["s1", "s2", "s3", None]), " ".join(rnd.choices(words, k=rnd.randrange(12)))) for _ in range(60)]
    rows += [("fr", "only", "too rare"), ("fr", "other", None), ("en", "s1", "the " * 50_000), ("en", "empty", ""), ("en", "empty", "12 34 ...")]
    rows += [("en", "s9", "same tie tie")] * 4 + [("en", "s8", "same tie tie")] * 4
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, total long, p long")
    got = sorted(tuple(r) for r in divergence.audit(frame).collect())
    assert got == audit_by_hand(rows)
    assert divergence.audit(frame.filter("false")).collect() == []


def test_joint_levels_over_many_columns(spark):
    rnd = random.Random(5)
    cells = [("l", f"s{s}", f"t{t}", rnd.randrange(1, 40)) for t in range(150) for s in range(60) if rnd.random() < 0.6]
    assert len({(s, p) for _, s, _, p in cells}) > divergence.TILE
    frame = spark.createDataFrame([(*c[:3], 1, c[3]) for c in cells], "lang string, source string, term string, total long, p long")
    by_term = defaultdict(list)
    for _, s, t, p in cells:
        by_term[t].append((s, p))
    want = Counter((a, pa, b, pb) for row in by_term.values() for (a, pa), (b, pb) in combinations(sorted(row), 2))
    assert {tuple(r[1:5]): r["terms"] for r in divergence.joint_levels(frame).collect()} == want


def test_shares_of_large_counts_are_exact(spark):
    counts = [0, 5, divergence.LONG_COUNT - 1, divergence.LONG_COUNT, 10**15]
    rows = spark.createDataFrame([(c, 10**16, 1000) for c in counts], "n long, size long, v long")
    got = [r[0] for r in rows.select(divergence.share(rows.n, rows["size"], rows.v)).collect()]
    assert got == [1 + 10**9 * (c + 1) // (10**16 + 1000) for c in counts]


# ---- op12


def test_selection_equals_sorting(spark):
    rnd = random.Random(6)
    staging = Staging(spark, "test-selection")
    rows = [(rnd.randrange(40) - 20, rnd.randrange(5), i) for i in range(4000)] + [(7, 7, 10_000 + i) for i in range(2000)]
    rnd.shuffle(rows)
    table = staging.put(spark.createDataFrame(rows, "a long, b long, c long").repartition(7), "rows")
    ordered = sorted(rows)
    for k in (1, 2, 599, 3000, 5999, 6000):
        assert resample.smallest(Staging(spark, "test-selection"), table, ["a", "b", "c"], k) == ordered[k - 1]


def test_weighted_median_leaves_a_quarter_on_both_sides():
    rnd = random.Random(7)
    for _ in range(200):
        parts = [sorted((rnd.randrange(50), i, j) for j in range(rnd.randrange(1, 30))) for i in range(rnd.randrange(1, 12))]
        keys = sorted(k for p in parts for k in p)
        pivot = resample.weighted_median([(p[(len(p) - 1) // 2], len(p)) for p in parts])
        assert sum(k <= pivot for k in keys) * 4 >= len(keys) and sum(k >= pivot for k in keys) * 4 >= len(keys)


def by_hand(rows, target, ngram=1):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [" ".join(words[i : i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % 10_000

    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in rows], target))
    out = []
    for i, text in rows:
        n, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], math.inf if r[0] is None else r[0], r[2]))
    drawn = able[: 10 * len(able) // 100]
    return sorted(((r[0], *r[2:], None) for r in out), key=str), [(r[0], *r[2:], k + 1) for k, r in enumerate(drawn)]


@pytest.mark.parametrize("ngram", [1, 2])
def test_resampling_of_odd_rows(spark, docs_of, ngram):
    rnd = random.Random(8)
    words = ["alpha", "Beta", "9lives", "été", "x_y", "gamma.", "the"]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randrange(45)))) for i in range(150)]
    rows += [(5, "the beta " * 30)] * 6 + [(None, "gamma " * 25), (None, None), (200, None), (201, ""), (202, "...")] + [(203, "word " * 300_000)]
    target = ["gamma gamma the", None, ""]
    got = resample.resample(docs_of(rows), spark.createDataFrame([(t,) for t in target], "text string"), ngram=ngram).collect()
    everything, drawn = by_hand(rows, target, ngram)
    assert sorted(((*tuple(r)[:4], None) for r in got), key=str) == everything
    assert sorted((tuple(r) for r in got if r["rank"]), key=lambda r: r[4]) == drawn


def test_resampling_without_rows(spark, docs_of):
    none = docs_of([(1, "x")]).filter("false")
    assert resample.resample(none, none).collect() == []
    few = resample.resample(docs_of([(1, "one two")]), none).collect()
    assert [(r["doc_id"], r["rank"]) for r in few] == [(1, None)]


# ---- op13

PLAIN = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                 r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def checksum(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plainly(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split(".")) or kind == 2 and 14 <= len(digits) <= 19 and checksum(digits)
                    or kind == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(9)
    parts = ["a", "1", "23", "456", ".", "@", "+", "-", " ", "(", ")", "4111 1111 1111 1111", "é", "300", "\n", "0001", "a@b.cd"]
    for _ in range(20_000):
        text = "".join(rnd.choices(parts, k=rnd.randrange(25)))
        assert pii.base_spans(text) == plainly(text), text


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 0"))


def test_query_keeps_base_spans(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    found = QUERIES["op13_personal_data"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        base = plainly(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        written = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(written) <= set(spans) and len(spans) == len(written) + r["n_added"]
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])))


def test_viterbi_equals_all_segmentations(model):
    def every(j, ending):  # (score, spans) of all segmentations of the first j tokens
        if not j:
            yield 0.0, ()
            return
        for score, spans in every(j - 1, ending):
            yield score, spans
        for i, k, s in ending.get(j, ()):
            for score, spans in every(i, ending):
                yield score + s, (*spans, (i, k, j))

    for text in ("call (652) 555-4544 now", "a.b [at] c.de 10[.]1[.]2[.]3", "x at y dot org", "4111.1111.1111.1111 12", "2024-01-31 10:22"):
        stretch, ending = pii.Stretch(text, 0, len(text)), {}
        for i, j, kinds in stretch.candidates():
            for k in kinds:
                ending.setdefault(j, []).append((i, k, sum(float(model.weights[f][k]) for f in stretch.features(i, j) if f in model.weights)))
        best = max(score for score, _ in every(len(stretch.tokens), ending))
        got = [(stretch.at.index(a), k, next(t for t in range(len(stretch.tokens)) if stretch.at[t] + len(stretch.tokens[t]) == b) + 1) for a, k, b in model.decode(stretch)]
        scores = {(i, k, j): s for j, found in ending.items() for i, k, s in found}
        assert math.isclose(sum(scores[g] for g in got), best, abs_tol=1e-6)


def test_other_spellings_of_held_out_spans(model):
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE doc_id % 2 = 1 AND regexp_matches(text, '[0-9@]') ORDER BY doc_id").fetchall()
    rnd, hits, wanted, false, wrong = random.Random(10), Counter(), Counter(), 0, 0
    for (text,) in rows:
        for a, kind, b in pii.base_spans(text):
            good, bad = pii.rewrites(kind, text[a:b], rnd)
            for form in good:
                line = f"and the {form} of them"
                wanted[kind] += 1
                hits[kind] += any(k == kind and x <= 9 and y >= 7 + len(form) for x, k, y in (s for part in pii.scan(line, model) for s in part))
            for form in bad:
                line = f"and the {form} of them"
                wrong += 1
                false += bool(model.added(line, pii.base_spans(line)))
    assert all(hits[k] >= 0.9 * wanted[k] > 50 for k in range(4)), (hits, wanted)
    assert false <= 0.05 * wrong, (false, wrong)


def test_clean_documents_get_no_spans(model):
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE doc_id % 2 = 1").fetchall()
    clean = [t for (t,) in rows if t and not plainly(t)]
    assert sum(bool(model.added(t, [])) for t in clean) <= 0.002 * len(clean)


def test_personal_data_of_odd_rows(spark, docs_of, model):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (3, "call (652) 555-4544"), (3, "call (652) 555-4544"), (4, "jane [at] host dot org")]
    got = sorted((tuple(r) for r in pii.find_pii(docs_of(rows), model).collect()), key=str)
    assert [(r[0], r[6], r[7]) for r in got] == [(1, "", 0), (2, "", 0), (3, "phone:5:19", 1), (3, "phone:5:19", 1), (4, "email:0:22", 1), (None, "email:0:6", 0)]
    assert pii.find_pii(docs_of(rows).filter("false"), model).collect() == []
    masked = pii.redacted(docs_of(rows), model)
    assert masked.columns == docs_of(rows).columns
    assert sorted((r["text"] for r in masked.collect()), key=str) == sorted([None, "", "[EMAIL]", "call [PHONE]", "call [PHONE]", "[EMAIL]"], key=str)


def test_a_sample_without_spans_adds_nothing(docs_of):
    model = pii.fit(docs_of([(1, "call (652) 555-4544"), (2, None), (None, "a@b.cd")]))
    assert model.weights == {} and model.added("call (652) 555-4544", []) == []


@pytest.mark.parametrize("piece", ["a", "1", "1.", "a@", "@", "+1", "+1(", "1-", "at ", " at x dot ", "[at]", "1[.]", "(", "1 2 "])
def test_long_texts_take_linear_time(model, piece):
    started = time.process_time()
    pii.scan(piece * 5_000, model)
    once = time.process_time() - started
    started = time.process_time()
    pii.scan(piece * 20_000, model)
    assert time.process_time() - started < 8 * once + 0.5


def test_packing_ranks_pieces_without_their_ids(spark, docs_of, monkeypatch):
    """The pipeline's packing stage: ids stay out of the sort and the Python passes, and each piece gets its own back."""
    import zlib

    from otif.llm import packing
    from otif.llm.tokens import default_tokenizer

    ranked = []
    sums = packing.prefix_sums
    monkeypatch.setattr(packing, "prefix_sums", lambda staging, df, *a: ranked.append(df.columns) or sums(staging, df, *a))
    docs = docs_of([(1, "a b c"), (1, "a b c"), (1, "other words " * 1500), (2, None), (None, ""), (3, "c d " * 40)])
    got = packing.pack(docs, default_tokenizer(), with_ids=True)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows = got.collect()
    assert ranked and all("ids" not in columns for columns in ranked)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    plain = packing.pack(docs, default_tokenizer()).collect()
    facts = [sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in x) for x in (rows, plain)]
    assert facts[0] == facts[1]
    taken = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(o == 0 if k == 0 or taken[k - 1][0] != s else o == taken[k - 1][1] + taken[k - 1][2] for k, (s, o, _) in enumerate(taken))
