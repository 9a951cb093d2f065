import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import cutoffs, encodings, langid, leaks, lookalikes, packing, quality, reading, repetition, scans
from docloom.llm.languages import code


def sentences(n, words, seed=0):
    r = random.Random(seed)
    return [" ".join(r.choice(words) for _ in range(r.randint(4, 9))).capitalize() + "." for _ in range(n)]


# 1


EN = "the house every cat sees some dog because our old tree needs a river and this door".split()
DE = "das haus jede katze sieht ein hund weil unser alter baum braucht einen fluss und diese tür".split()
RU = "этот дом каждая кошка видит собаку потому что наше старое дерево река и дверь".split()


@pytest.fixture(scope="module")
def models():
    sample = {lang: [" ".join(sentences(12, words, s)) for s in range(12)] for lang, words in (("en", EN), ("de", DE), ("ru", RU))}
    sample["ru"][3] = " ".join(sentences(12, EN, 99))  # a wrong label
    return langid.train(sample)


def test_code_lengths_are_those_of_ppm():
    """Brute force: escapes from the longest seen context down, method C, frozen counts."""
    texts = {"a": ["abracadabra abra"], "b": ["banana bandana"]}
    m = langid.Models(texts)
    for query in ("abra", "bandabra", "xyz", "ana b"):
        for j, lang in enumerate(m.languages):
            counts = {}
            for t in texts[lang]:
                raw = b" " * langid.ORDER + t.encode()
                for i in range(langid.ORDER, len(raw)):
                    for k in range(langid.ORDER + 1):
                        own = counts.setdefault(raw[i - k : i], {})
                        own[raw[i]] = own.get(raw[i], 0) + 1
            raw, total = b" " * langid.ORDER + query.encode(), 0.0
            for i in range(langid.ORDER, len(raw)):
                for k in range(langid.ORDER, -2, -1):
                    if k < 0:
                        total += 8
                        break
                    own = counts.get(raw[i - k : i])
                    if own is None:
                        continue
                    n, q = sum(own.values()), len(own)
                    if raw[i] in own:
                        total -= np.log2(own[raw[i]] / (n + q))
                        break
                    total -= np.log2(q / (n + q))
            assert m.bits([query])[0][0, j] == pytest.approx(total, abs=1e-3)


def test_languages_of_records_and_passages(models):
    read = langid.Reader(models).read
    en, de = " ".join(sentences(3, EN, 7)), " ".join(sentences(3, DE, 8))
    one, mixed, quoted, none, garbled, empty = read([en, f"{en} {de}\n\n{de}", f"{en} {sentences(1, DE, 9)[0]} {en}", "zxkq wvb jjq xzzk qqwv bxk zzv", " ".join(sentences(3, RU, 5)).encode().decode("latin-1"), ""])
    assert one[0] == "en" and len({p[1] for p in one[2]}) == 1 and one[1] > 0.99
    assert [(p[0], p[1]) for p in mixed[2]] == [(1, "de"), (1, "en"), (2, "de")]
    assert {p[1] for p in quoted[2]} == {"en"}
    assert none[0] is None and empty[0] is None
    assert garbled[0] == "ru"


@pytest.mark.parametrize(("label", "lang"), [("EN", "en"), ("en-GB", "en"), ("deu", "de"), ("French", "fr"), ("", None), ("??", None), (None, None), ("und", None), (" pt_BR ", "pt")])
def test_labels(label, lang):
    assert code(label) == lang


# 2


@pytest.fixture(scope="module")
def pages():
    from collections import Counter

    words = "the and every child house river paper between garden because morning returns reader table".split()
    counts = Counter({w: 1000 for w in words}) | Counter({"tbe": 2, "bouse": 1})
    return scans.Pages(scans.Words({"en": counts, scans.HEADS: Counter({"": 9, "vol": 9, "papers": 9})}), frozenset({"Vol. #. @ @ Papers"}))


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("The child and the house returns because every river returns.", set()),
        ("The child and the hou-\nse returns because every river.", {"divided", "line break"}),
        ("The child and the gar- den returns.", {"divided"}),
        ("Tbe child and the bouse returns.", {"misread"}),
        ("The child and the r i v e r returns.", {"spaced"}),
        ("The child and thegarden returns.", {"glued"}),
        ("The child ~ and the river returns.", {"speck"}),
        ("Vol. 3. Zamo Kelu Papers", {"header"}),
        ("4  Vol. 3. The Kelu Papcrs", {"header"}),
        ("The child and the Vol. 3. Zamo Kelu Papers river returns.", {"header"}),
        ("The child and   the house   returns because every river ret- urns.", {"divided"}),
        ("- 12 -", {"page number"}),
        ("xiv", {"page number"}),
        ("- the child\n- the river\n- the house", set()),
        ("| the | child |\n| --- | --- |\n| river | 3 |", set()),
        ("zxq 7f\nqqw 01\nkkz", set()),
        ("", set()),
    ],
)
def test_traces(pages, text, kinds):
    assert {k for k, *_ in pages.traces(text)} == kinds


def test_mended(pages):
    text = "Vol. 3. Zamo Kelu Papers\n\nThe child and the hou-\nse returns ~ because the r i v e r\nand thegarden returns to tbe table.\n\n7"
    assert scans.mend(pages, text) == "The child and the house returns because the river and the garden returns to the table."


def test_paragraphs_go_on_across_runs_of_segments(spark, pages):
    rows = [("s", i, "mupdf", 100 + i, t) for i, t in ((510, "The child returns."), (511, "The river and"), (512, "- 9 -"), (513, "the house returns."), (514, "The garden."))]
    df = spark.createDataFrame(rows, "sha256 string, seg_index int, backend string, seg_id bigint, content string")
    got = {r.seg_id: r.para_id for r in scans.paragraphs(df, spark.sparkContext.broadcast(pages)).collect()}
    assert got == {610: 610, 611: 611, 612: 612, 613: 611, 614: 614}


def test_paragraphs_equal_brute_force_whatever_the_runs(spark):
    r = random.Random(9)
    texts = ["", "Ends here.", "begins low and", "Stays open", "low end.", "Of all"]
    rows = [(d, "mupdf", i, d_no * 1000 + i, r.choice(texts)) for d_no, d in enumerate(("s", "t", None)) for i in range(90)]
    df = spark.createDataFrame(rows, "sha256 string, backend string, seg_index int, seg_id bigint, mended string")
    wanted, last, head = {}, {}, {}
    for d, _, _, k, text in rows:
        if text:
            if not (d in last and not last[d].endswith(".") and text[0].islower()):
                head[d] = k
            last[d] = text
            wanted[k] = head[d]
        else:
            wanted[k] = k
    for run in (1, 4, 7, 512):
        assert {x.seg_id: x.para_id for x in scans.joined(df, run).collect()} == wanted


def test_neighbours_tell_misreadings_from_words(spark):
    """'tbe' stands where 'the' does, 'fbe' never: only the first is a misreading."""
    text = "Under the old tree sat a child. " * 200 + "Under tbe old tree sat a child. " * 4 + "Nobody knows what stands for fbe exam papers. " * 4
    docs = spark.createDataFrame([(1, text, "en", "a"), (2, "Under the bridge flows a river.", "en", "b")], "ext_id bigint, markdown string, lang string, source string")
    words = scans.fit(docs).words
    assert words.judge("tbe", "en") == ("misread", "the")
    assert words.judge("fbe", "en") is None and ("en", "fbe") in words.unsupported


def test_headers_of_a_source_beside_others(spark):
    """A header on few pages of a small source stays one beside any number of records of other sources."""
    schema = "kind string, of string, what string, a string, b string, n bigint, alone bigint"
    own = [("line", "small", "Vol. # @", None, None, 5, 5), ("record", "small", "", None, None, 20, 0)]
    other = [("line", "large", "see # @", None, None, 5, 5), ("record", "large", "", None, None, 10**9, 0)]
    found = lambda rows: {r.masked for r in scans.header_forms(spark.createDataFrame(rows, schema)).collect()}
    assert found(own) == found(own + other) == {"Vol. # @"}


# 3


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("ｃａｆé", "café", True),
        ("pаge", "page", True),
        ("ﬁne", "fine", True),
        ("a​b­c", "abc", True),
        ("a b c", "a b c", True),
        ("Ά", "Á", True),
        ("page", "Page", False),
        ("resume", "résumé", False),
        ("x2", "x²", False),
        ("a-b", "a‐b", False),
        ("a  b", "a b", False),
        ("\uff76\uff9e", "\u30ac", True),
        ("e\u200b\u0301", "\u00e9", True),
        ("\uff43\u0327a", "\u00e7a", True),
        ("\u13aa\u216c", "AL", True),
        ("\ua4d0\u2c9fx", "Box", True),
        ("\u06001", "1", False),
        ("\u06dd1", "1", False),
        ("\u0441\u0301", "\u0107", True),
        ("\u0438", "u", False),
    ],
)
def test_one_form(a, b, same):
    assert (lookalikes.one_form(a) == lookalikes.one_form(b)) is same
    assert all(lookalikes.one_form(lookalikes.one_form(x)) == lookalikes.one_form(x) for x in (a, b))


def test_readable_keeps_scripts():
    assert lookalikes.readable("сор и дом на реке у горы") == "сор и дом на реке у горы"
    assert lookalikes.readable("pаge") == "page"
    assert lookalikes.readable("этот зaвoд") == "этот завод"
    assert lookalikes.readable("naпve") == "naпve"


def test_conflicting_rules_are_refused(monkeypatch):
    monkeypatch.setitem(lookalikes.LOOKALIKES, "Again", ("а", "q"))
    with pytest.raises(lookalikes.ConflictError):
        lookalikes.compiled.__wrapped__()


def test_pairs_leave_copies_alone(spark):
    rows = [(i, "the same page") for i in range(40)] + [(100, "the same pаge"), (101, "other"), (102, "other"), (103, "​"), (104, " ")]
    got = lookalikes.same_looking_pairs(spark.createDataFrame(rows, "id bigint, t string"), "id", "t")
    assert sorted(map(tuple, got.collect())) == [(i, 100) for i in range(40)]


# 4


CHAINS = [("utf-8", "cp1252"), ("cp1252", "cp1251"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("cp1252", "mac_roman"), ("utf-8", "cp1251")]


def garble(text, right, wrong):
    return text.encode(right).decode(wrong, "replace")


@pytest.fixture(scope="module")
def model():
    from collections import Counter

    words = "garçon près légende où élève théorème fenêtre café forêt numéro société".split()
    r = random.Random(1)
    clean = [" ".join(r.choice(words + ["le", "dans", "une", "chaque", "maison", "pour"]) for _ in range(60)) for _ in range(120)]
    bad = [garble(t[:80], *CHAINS[i % len(CHAINS)]) for i, t in enumerate(clean[:24])]
    sums, read = Counter(), {}
    encodings._count(clean + bad, ["a"] * 144, sums, read)
    return encodings.Model([(*k, n) for k, n in sums.items()])


@pytest.mark.parametrize(("right", "wrong"), CHAINS)
def test_exact_round_trip(model, right, wrong):
    text = "le garçon près de une légende où chaque élève"
    assert garble(text, right, wrong) != text
    assert model.restore(garble(text, right, wrong), "a")[0] == text


def test_clean_and_lost_text(model):
    assert model.restore("le garçon dans une forêt", "a") == ("le garçon dans une forêt", 0)
    assert model.restore("le gar�on", "a")[1] == 1
    assert model.restore("plain", None) == ("plain", 0)


# 5


def brute_repetition(text):
    w = repetition._WORD.findall(repetition._SIGNS.sub("", repetition._MARKUP.sub(" ", text)).lower())
    weight = [1 if "㐀" <= x[0] <= "鿿" else 2 for x in w]
    covered, seen, n = [0] * len(w), set(), len(w)
    for i in range(n):
        for size in range(5, 11):
            if i + size <= n and sum(weight[i : i + size]) >= 10:
                key = tuple(w[i : i + size])
                if key in seen:
                    covered[i : i + size] = [1] * size
                seen.add(key)
                break
    longest = max((next(k for k in range(n) if i + k >= n or w[i + k] != w[j + k]) for i in range(n) for j in range(i)), default=0)
    return sum(weight) / 2, sum(a * b for a, b in zip(weight, covered, strict=True)) / 2, longest


def test_repetition_equals_brute_force():
    r = random.Random(3)
    texts = ["", "a " * 30, "<td>x</td> " * 9] + [" ".join(r.choice("abcdef") for _ in range(r.randint(0, 50))) for _ in range(40)] + ["".join(r.choice(["该", "的", "机", "a ", "b "]) for _ in range(50)) for _ in range(20)]
    m = repetition.measure(texts)
    assert [(m["words"][i], m["repeated"][i], m["longest"][i]) for i in range(len(texts))] == [brute_repetition(t) for t in texts]
    for t in ("", "no word twice", "one two one two", "a b c d e f a b c d e f"):
        m = repetition.measure([t])
        assert (m["words"][0], m["repeated"][0], m["longest"][0]) == brute_repetition(t)


# 6


def test_chunks_merge_to_the_whole():
    r = random.Random(5)
    words = "the cat (house) tree, 12 3.5 dog. river".split()
    common = frozenset({"the", "cat", "house"})
    for _ in range(30):
        lines = [r.choice(["", "- ", "| ", "# ", ""]) + " ".join(r.choice(words) for _ in range(r.randint(0, 40))) for _ in range(20)]
        text = "\n".join(lines)
        at = quality.cut(text, 120)
        states = [quality.measure(text[a:b], common, text[a - 1 : a] if a else "", text[b : b + 1]) for a, b in zip(at, at[1:], strict=False)]
        assert len(states) > 3
        left = states[0]
        for s in states[1:]:
            left = left.merge(s)
        right = states[-1]
        for s in reversed(states[:-1]):
            right = s.merge(right)
        whole = quality.measure(text, common).finish()
        for n in quality.NUMBERS:
            assert left.finish()[n] == right.finish()[n] == whole[n], n


def test_kinds(spark, monkeypatch):
    monkeypatch.setattr(quality, "COMMON_LEAST", 1)
    prose = "The cat sees every dog because our house needs a tree. The river returns. " * 5
    rows = [(1, prose), (2, "- cat\n- dog tree\n- river\n- house"), (3, "| cat | dog |\n| --- | --- |\n| tree | 3 |\n\nThe cat sees every dog."), (4, "7f3a 99 1c ee 02\nkq zx 11 8b\n" * 9), (5, None), (6, "")]
    got = {r.ext_id: (r.is_list, r.is_table, r.is_junk) for r in quality.statistics(spark.createDataFrame(rows, "ext_id bigint, markdown string")).collect()}
    assert got[1] == (False, False, False) and got[2] == (True, False, False) and got[3] == (False, True, False)
    assert got[5] == got[6] == (False, False, False)


def test_huge_texts_are_cut_and_merged(spark, monkeypatch):
    text = ("The cat sees every dog because our house needs a tree.\n" * 50 + "\n") * 60
    df = spark.createDataFrame([(1, text)], "ext_id bigint, markdown string")
    assert len(text) > 2 * quality.CHUNK
    row = quality.statistics(df).first()
    whole = quality.measure(text, frozenset()).finish()
    assert (row.chars, row.words, row.lines, row.sentences) == (whole["chars"], whole["words"], whole["lines"], whole["sentences"])


# 7


def test_common_words_of_a_rare_language(spark):
    """Records of another language and source, however many, leave a record's kind alone."""
    dutch = "De oude molenaar vertelde zijn buren dat het graan dit jaar veel later rijp zou worden. Niemand geloofde hem eerst, maar de oogst kwam inderdaad pas in de herfst binnen."
    rows = [(i, dutch, "nl", "a") for i in range(5)] + [(10 + i, dutch, None, "c") for i in range(5)]
    more = [(1000 + i, "The miller told his neighbours that the grain would ripen late this year. Nobody believed him.", "en", "b") for i in range(12_000)]
    schema = "ext_id bigint, markdown string, lang string, source string"
    few, many = (spark.createDataFrame(x, schema) for x in (rows, rows + more))
    of = lambda df: {r.ext_id: tuple(r) for r in quality.statistics(df).where("ext_id < 1000").collect()}
    alone = of(few)
    assert alone == of(many) and not any(r[quality_column("is_junk", few)] for r in alone.values())


def quality_column(name, df):
    return quality.statistics(df).columns.index(name)


def test_texts_without_a_space_are_measured_whole():
    for text in ("x" * 160_000, "机" * 160_000, "word." * 40_000, "a b " * 40_000 + "y" * 90_000):
        at = quality.cut(text)
        common = frozenset({"word"})
        state = None
        for a, b in zip(at, at[1:], strict=False):
            own = quality.measure(text[a:b], common, text[a - 1 : a] if a else "", text[b : b + 1])
            state = state.merge(own) if state else own
        assert state.finish() == quality.measure(text, common).finish()


@pytest.mark.parametrize("keep", [0, 1, 33, 50, 99, 100])
def test_cutoff_is_the_order_statistic(spark, keep):
    r = random.Random(keep)
    scores = [r.choice([0.1, 0.25, 0.5, r.random(), 1e-300, 1e300, -5.0]) for _ in range(200)]
    results = spark.createDataFrame([(i, "a", "m", s) for i, s in enumerate(scores)], "result_id bigint, source string, extract_backend string, quality_score double")
    targets = spark.createDataFrame([("a", "m", keep)], "source string, extract_backend string, keep_percent int")
    row = cutoffs.cutoffs(results, targets).first()
    wanted = max(s for s in scores if 100 * sum(x >= s for x in scores) >= keep * len(scores))
    assert row.cutoff == wanted and row.n_kept == sum(x >= wanted for x in scores)


def test_pinball_loss_is_convex_with_its_subgradient():
    values = sorted([0.1, 0.4, 0.4, 0.9, 1.3])
    direct = lambda c: sum(70 * (v - c) if v >= c else 30 * (c - v) for v in values)
    for split, c in ((1, 0.3), (3, 0.6), (4, 1.0)):
        loss, slope = cutoffs.pinball_loss(c, 5, sum(values), 5 - split, sum(values[split:]), 30)
        assert loss == pytest.approx(direct(c))
        assert slope == pytest.approx((direct(c) - direct(c - 1e-6)) / 1e-6, abs=1e-3)


def test_a_cutoff_has_the_least_loss(spark):
    r = random.Random(5)
    scores = [round(r.lognormvariate(0, 2), 3) for _ in range(400)]
    results = spark.createDataFrame([(i, "a", "b", s) for i, s in enumerate(scores)], "result_id bigint, source string, extract_backend string, quality_score double")
    for keep in (3, 50, 90):
        targets = spark.createDataFrame([("a", "b", keep)], "source string, extract_backend string, keep_percent int")
        row = cutoffs.optimality(results, targets).first()
        losses = {c: sum((100 - keep) * (s - c) if s >= c else keep * (c - s) for s in scores) for c in set(scores)}
        assert row.loss == pytest.approx(min(losses.values())) and losses[row.cutoff] == pytest.approx(row.loss)
        assert row.slope_below <= 0 < row.slope_above


# 8


@pytest.mark.parametrize("top_up", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_item_once(seed, top_up):
    r = np.random.default_rng(seed)
    capacity = 64
    counts = np.zeros(capacity + 1, np.int64)
    counts[1:] = r.integers(0, 9, capacity)
    p = packing.plan(counts, capacity, top_up)
    fill, held = np.zeros(p.containers, np.int64), [[] for _ in range(p.containers)]
    for s in range(1, capacity + 1):
        for c in p.place(np.full(counts[s], s), np.arange(counts[s])).tolist():
            fill[c] += s
            held[c].append(s)
    total = int((counts * np.arange(capacity + 1)).sum())
    assert fill.min() > 0 and fill.max() <= capacity and fill.sum() == total
    if top_up:
        assert p.containers <= 1.1 * -(-total // capacity) + 1
    else:  # a batch has items of one bucket only, as many as the bucket's end allows, and the padding is what the programme found
        end = lambda s: next(e for e in p.bucket_ends if s <= e)
        assert all(len({end(s) for s in c}) == 1 and len(c) <= capacity // end(c[0]) for c in held)
        assert p.containers * capacity - total == p.padding


def test_the_plan_rests_on_the_buckets():
    counts = np.zeros(65, np.int64)
    counts[[3, 9, 14, 20, 31, 40]] = [50, 7, 30, 12, 25, 8]
    own, other = packing.plan(counts, 64), packing.plan(counts, 64, ends=[64])
    assert len(own.bucket_ends) > 1 and own.containers < other.containers
    assert not np.array_equal(own.first, other.first)


def test_hot_lengths_are_ranked_in_windows(spark):
    df = spark.createDataFrame([(i, "the house sees a cat" if i % 3 else "a cat") for i in range(900)], "doc_id bigint, text string")
    bins = spark.createDataFrame([("b", 64)], "bin_name string, capacity_tokens int")
    few, many = packing.packed(df, bins, window=50).collect(), packing.packed(df, bins).collect()
    fill = {}
    for r in few:
        fill[r.container] = fill.get(r.container, 0) + r["size"]
    assert len(few) == 900 and max(fill.values()) <= 64
    assert sorted(fill) == list(range(len(fill))) and len(fill) == len({r.container for r in many})


def test_buckets_are_optimal():
    counts = np.zeros(11, np.int64)
    counts[[2, 3, 5, 7, 10]] = [4, 3, 2, 5, 1]
    lengths = [2, 3, 5, 7, 10]

    def cost(ends):
        total, low = 0, 0
        for b in ends:
            n = sum(int(counts[s]) for s in lengths if low < s <= b)
            total += -(-n // (10 // b)) * 10 - sum(int(counts[s]) * s for s in lengths if low < s <= b)
            low = b
        return total

    from itertools import combinations

    every = [cost([*c, 10]) for k in range(5) for c in combinations(lengths[:-1], k)]
    ends, padding = packing.buckets(counts, 10)
    assert padding == min(every) == cost(ends)


# 9


def searched(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    return {(r.doc_id, r.item_id): r.contained for r in leaks.leaks(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}


def brute_leaks(docs, items):
    wanted = set()
    for d, text in enumerate(docs):
        w = text.lower().split()
        runs = {tuple(w[k : k + 6]) for k in range(len(w) - 5)}
        for i, t in items:
            v = t.split()
            inside = {j for k in range(len(v) - 5) if tuple(v[k : k + 6]) in runs for j in range(k, k + 6)}
            if 5 * len(inside) >= 2 * len(v):
                wanted.add((d, i))
    return wanted


@pytest.mark.parametrize("sent", [leaks.SENT, 0])
def test_leaks_equal_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(leaks, "SENT", sent)
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(6, 400)))) for i in range(12)]
    docs = []
    for i in range(60):
        body = [r.choice(words) for _ in range(r.randint(0, 300))]
        source = r.choice(items)[1].split()
        k = r.randint(0, len(source))
        part = [w if r.random() > 0.05 else "ERR" for w in source[:k]]
        docs.append(" ".join(body[:50] + part + body[50:]))
    wanted = brute_leaks(docs, items)
    assert set(searched(spark, docs, items)) == wanted and wanted


def test_recall_of_items_of_all_sizes(spark):
    """Items of 10 to 50 000 words, each barely leaking: runs of six words, which share the fewest shingles."""
    r = random.Random(7)
    items, docs = [], []
    for size in (10, 30, 60, 120, 300, 1000, 5000, 50_000):
        for _ in range(3 if size > 1000 else 12):
            i = len(items)
            item = [f"i{i}w{r.randrange(10**6)}" for _ in range(size)]
            items.append((i, " ".join(item)))
            runs = -(-2 * size // 30) + (size > 60)
            at = [k * (size // runs) for k in range(runs)]
            docs.append(" ".join(x for k in at for x in (*item[k : k + 6], f"d{r.randrange(10**6)}", "x")))
    wanted = brute_leaks(docs, items)
    assert len(wanted) == len(items)
    assert len(set(searched(spark, docs, items)) & wanted) >= 0.99 * len(wanted)
    rows = leaks.grams(spark.createDataFrame(items, "passage bigint, body string"))
    kept = {r.size: r.kept for r in rows.groupBy("size").agg((F.count("class") / F.count("*")).alias("kept")).collect()}
    assert kept[10] == 1 and 0.5 < kept[120] < 0.95 and kept[50_000] < 0.01  # the sketches of large items are small


def test_least_shared_shingles():
    assert leaks.least_shared([1] * 95, 100) == 7
    assert leaks.least_shared([1] * 5, 10) == 1
    assert leaks.least_shared([95], 100) == 1


def test_filter_stops_none_of_its_own():
    h = np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.uint64)
    f = leaks.Filter(17)
    f.add(h[:1500])
    assert f.has(h[:1500]).all() and f.has(h[1500:]).mean() < 0.01


def test_stock_instructions_are_no_passage(spark):
    items = [(i, f"Answer the question below in one word.\n\nword{i} one two three four five six") for i in range(1, 5)] + [(9, "word1 one two three four five six")]
    found = leaks.bodies(spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert all("answer" not in r.body for r in found)
    assert len({r.passage for r in found if r.item_id in (1, 9)}) == 1


def test_case_markup_and_line_division_aside(spark):
    assert (0, 1) in searched(spark, ["<b>THE quick,</b> brown fox jum-\nps\nover one lazy dog"], [(1, "The quick brown fox jumps over one lazy dog")])


# 10


def test_held_out_levels(spark, tiny_dir):
    """Accuracy on graded samples that the fit has not seen."""
    rows = [r for r in spark.read.parquet(f"{tiny_dir}/level_samples.parquet").orderBy("sample_id").collect()]
    right = total = 0
    for fold in range(4):
        model = reading.Model(reading._sample_counts([r for r in rows if r.sample_id % 4 != fold]))
        test = [r for r in rows if r.sample_id % 4 == fold and len(r.text.split()) >= reading.MIN_WORDS]
        block = reading.Words([r.text for r in test])
        for r, ll in zip(test, model.score(block.rows(model), block.sizes), strict=True):
            ll = ll.reshape(-1, reading.LEVELS)
            right += int(ll[ll.max(1).argmax()].argmax()) + 1 == r.reading_level
            total += 1
    assert right >= 0.97 * total and total > 150


def test_alternation_uses_all_documents(spark):
    samples = spark.createDataFrame([(1, "en", 1, "cat dog sun tree house " * 8), (2, "en", 4, "theorem covariance taxonomy lemma " * 8)], "sample_id bigint, lang string, reading_level int, text string")
    docs = spark.createDataFrame([(i, "theorem covariance taxonomy lemma quadrature manifold " * 10) for i in range(6)], "doc_id bigint, text string")
    model = reading.fit(docs, samples)[0]
    assert "quadrature" in model.ids and "quadrature" not in reading.fit(docs, samples, rounds=0)[0].ids
    assert {r.reading_level for r in reading.levels(docs, samples).collect()} == {4}


def test_alternation_raises_the_likelihood_until_it_converges(spark, tiny_dir):
    docs, samples = (spark.read.parquet(f"{tiny_dir}/{n}.parquet") for n in ("documents", "level_samples"))
    told = [r.log_likelihood for r in reading.likelihoods(docs, samples).orderBy("round").collect()]
    assert len(told) > 1 and told[-1] >= told[0]
    assert len(told) == reading.ROUNDS - 1 or told[-1] - told[-2] < reading.TOLERANCE


def test_other_languages_leave_difficulties_alone(spark, tiny_dir):
    docs, samples = (spark.read.parquet(f"{tiny_dir}/{n}.parquet") for n in ("documents", "level_samples"))
    own = docs.where("lang = 'en'").select("doc_id", "text")
    more = spark.range(2000).selectExpr("id + 10000000 doc_id", "concat_ws(' ', transform(sequence(1, 60), i -> concat('ord', (id * 7 + i * i) % 900, 'et'))) text").withColumn("text", F.translate("text", "0123456789", "abcdefghij"))
    level = lambda df: {r.doc_id: r.reading_level for r in reading.levels(df, samples).collect()}
    alone, beside = level(own), level(own.unionByName(more))
    assert alone and alone == {k: beside[k] for k in alone}


def test_hot_group_of_copies(spark):
    """A third of all rows in one group: results stay whole."""
    rows = [(i, "same text of many words that is copied again and again here") for i in range(300)] + [(i, f"other text number {i} of many different words") for i in range(300, 900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bins = spark.createDataFrame([("b", 64)], "bin_name string, capacity_tokens int")
    placed = packing.packed(df, bins)
    assert placed.count() == 900
    assert placed.groupBy("container").agg(F.sum("size").alias("n")).where("n > 64").count() == 0


def test_tokens_that_occur_once_tell_which_chains_are_at_work(spark):
    """Different garbled words of one source, each once: they add up to the source's share."""
    r = random.Random(4)
    words = [a + "é" + b + c for a in "bcdfglmnprst" for b in ("li", "ra", "to", "ne", "mi", "su") for c in ("ne", "ter", "de", "que")]
    clean = [" ".join(r.choice([w, "dans", "une", "maison"]) for w in r.sample(words, 60)) for _ in range(200)]
    once = [garble(f"le {w} dans une maison", "utf-8", "mac_roman") for w in words[:40]]
    rows = [(i, t, "a") for i, t in enumerate(clean)] + [(1000 + i, t, "b") for i, t in enumerate(once)]
    model = encodings.fit(spark.createDataFrame(rows, "ext_id bigint, markdown string, source string"))
    share = model.prior["b"][encodings.CHAINS.index(("mac_roman", "utf-8"))]
    assert share > 10 * model.prior["a"][encodings.CHAINS.index(("mac_roman", "utf-8"))] and share > 0.05


def test_words_beyond_those_in_memory_count_as_they_are(spark, monkeypatch):
    """With room for twenty words the others come from the file: the same counts, shares and restored texts."""
    r = random.Random(6)
    words = [a + b + c for a in ("gé", "fa", "mû", "l", "tr") for b in ("li", "ra", "çon", "ne") for c in ("ne", "tère", "de", "que", "ж")]
    clean = [" ".join(r.choice([w, "dans", "une", "maison"]) for w in r.sample(words, 40)) + " «ça»" for _ in range(60)]
    texts = clean + [garble(t, "utf-8", "cp1252") for t in clean[:9]]
    docs = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "ext_id bigint, markdown string, source string")

    def fitted():
        model = encodings.fit(docs)
        return model, sorted(map(tuple, encodings.restored(docs, model=model).collect()))

    whole, rows = fitted()
    monkeypatch.setattr(encodings, "MOST_WORDS", 20)
    model, found = fitted()
    assert len(whole.language.words) > 100 and len(rows) == 9
    assert {w: model.language.words[w] for w in whole.language.words} == pytest.approx(dict(whole.language.words))
    assert len(model.language.words) <= 20 and model.language.words["absent"] == 0
    assert model.language.total == pytest.approx(whole.language.total) and dict(model.language.pairs) == pytest.approx(dict(whole.language.pairs))
    assert model.any == pytest.approx(whole.any) and model.prior["b"] == pytest.approx(whole.prior["b"])
    assert found == rows


def test_what_other_records_hold_doesnt_hide_a_garbled_token(model, monkeypatch):
    """The same token, first in a source without the chain, then in one where the chain is at work."""
    k = encodings.CHAINS.index(("cp1251", "cp1252"))
    token = garble("garçon", "cp1252", "cp1251")
    rare = [1e-12] * len(encodings.CHAINS)
    monkeypatch.setattr(model, "prior", model.prior | {"clean": rare, "bad": [0.3 if i == k else p for i, p in enumerate(rare)]})
    monkeypatch.setattr(model, "bounds", None, raising=False)
    seen = [-3.0, *(0.0 if i == k else -60.0 for i, _ in encodings.readings(token))]
    monkeypatch.setattr(model, "scores", {(" ", " ", token): seen})
    model.safe.clear()
    assert model.restore(f"le {token} dans", "clean")[1] == 0
    assert model.restore(f"le {token} dans", "bad") == ("le garçon dans", 1)
    model.safe.clear()


def test_rare_words_count_as_they_are(spark, monkeypatch):
    """A rare word whose look-alike is less than 25 times as frequent stays, whatever share of all words it is."""
    monkeypatch.setattr(scans, "MIN_SHARE", 1e-2, raising=False)  # as in a corpus a hundred thousand times as large
    words = "the and every child house river paper between garden because morning returns reader table".split()
    r = random.Random(8)
    texts = [" ".join(r.choice(words) for _ in range(40)) + "." for _ in range(60)] + ["The bearer and the child."] * 70 + ["The hearer and the child."] * 5 + ["The dealer and the child."] * 45 + ["The dealcr and the child."]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    pages = scans.fit(spark.createDataFrame(rows, "ext_id bigint, markdown string, lang string"))
    got = [pages.words.judge(w, "en") for w in ("hearer", "dealcr")]
    assert got == [None, None] and pages.words.counts["en"]["hearer"] == 5


def test_sentences_garbled_after_a_right_beginning(models):
    """Seven words decoded rightly, the others not: the chain is found by all tokens."""
    words = " ".join(sentences(6, RU, 5)).replace(".", "").lower().split()
    piece = " ".join(words[:7]) + " " + " ".join(words[7:24]).encode().decode("cp1251", "replace")
    reader = langid.Reader(models)
    bits, sizes = models.bits([piece])
    before = bits[0].min() / sizes[0]
    reader._mend([piece], bits, sizes)
    assert bits[0].min() / sizes[0] < 0.75 * before
    assert models.languages[int(bits[0].argmin())] == "ru"


def test_each_text_is_measured_once(spark):
    """Texts are read once for the common words and once each for the whole and the huge ones, not again to tell these apart."""
    texts = ["The house by the river is old. " * 3, "one two\n" * 20_000, "x" * (quality.CHUNK + 1), None]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    plain = spark.createDataFrame(list(enumerate(texts)), "ext_id bigint, markdown string")
    got = {r.ext_id: r for r in quality.statistics(plain.mapInArrow(counted, plain.schema)).collect()}
    assert read.value <= 3 * len(texts)
    assert [got[i].words for i in range(4)] == [21, 40_000, 1, 0] and [got[i].chars for i in range(4)] == [len(t or "") for t in texts]
