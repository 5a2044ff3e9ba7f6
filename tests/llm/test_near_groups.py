import numpy as np

from tandem.llm import order_minhash


def brute_classes(texts):
    """The smallest number of each text's class, from the alignments of all pairs."""
    sh = [order_minhash.shingles(t) for t in texts]
    sets, cls = [set(x.tolist()) for x in sh], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 1.8 * len(sets[a] & sets[b]) >= 0.8 * (len(sets[a]) + len(sets[b])) - 1e-9 and cls[a] != cls[b] and order_minhash.aligned_similarity(sh[a], sh[b]):
                low, high = sorted((cls[a], cls[b]))
                cls = [low if c == high else c for c in cls]
    return cls


def test_sparse_links_in_a_templated_group_equal_brute_force(docs_frame):
    form, texts = ["form%d" % k for k in range(345)], []
    for k in range(289):  # each differs from the form in four places, of which two texts have one in common at most
        t, (a, b) = list(form), divmod(k, 17)
        for group in range(4):
            place = 5 * (17 * group + (a + group * b) % 17)
            t[place : place + 3] = [f"own{k}x{group}x{j}" for j in range(3)]
        texts.append(t)
    for k in range(0, 289, 100):  # a second text that is similar to this one alone
        t = list(texts[k])
        t[300:330] = [f"more{k}x{j}" for j in range(30)]
        texts.append(t)
    texts = [" ".join(t) for t in texts]
    want = brute_classes(texts)
    assert len(texts) > len(set(want)) > 200
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs_frame([(k, t, "en", "s") for k, t in enumerate(texts)])).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_short_texts_equal_brute_force(docs_frame):
    rng = np.random.default_rng(5)
    word = lambda: "w%d" % rng.integers(0, 5000)
    texts = []
    for n in [*range(1, 31), 45, 60, 64, 70, 78]:
        for _ in range(8):
            base = [word() for _ in range(n)]
            texts += [" ".join(base), " ".join([*base, word()])]  # one word more
            if n > 20:
                texts.append(" ".join([*base, *[word() for _ in range(n // 6)]]))
    license = [f"line{k}" for k in range(12)]
    texts += [" ".join([*license, *[word() for _ in range(6)]]) for _ in range(40)]  # a passage alone links nothing
    want = brute_classes(texts)
    assert len(set(want)) < len(texts) - 150 and all(want[k] == k for k in range(len(texts) - 40, len(texts)))
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs_frame([(k, t, "en", "s") for k, t in enumerate(texts)])).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_prefixes_meet_at_the_least_similarity():
    rng = np.random.default_rng(1)
    for n in range(4, 61):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        for m in range(n, n * 5 // 4 + 1):
            b = np.concatenate([a, rng.integers(0, 2**63, m - n).astype(np.uint64)])
            counts = rng.integers(0, 9, order_minhash.SLOTS)
            assert set(order_minhash.prefix_keys(a, counts)) & set(order_minhash.prefix_keys(b, counts))
