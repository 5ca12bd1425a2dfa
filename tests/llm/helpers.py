"""Documents with the awkward cases, and brute-force versions of the operators."""

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
        "phi chi psi omega one two three four five six seven eight nine ten eleven twelve thirteen fourteen")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward():
    """(doc_id, text): nulls, empty texts, ties, repeated rows, a very long text, copies and near copies."""
    near = BASE + "!"
    long_text = "\n".join(f"{BASE} line {i} of a very long text" for i in range(400))
    return [
        (5, BASE), (3, near), (9, BASE.upper()), (7, None), (2, ""), (2, ""), (11, " \t\n "), (4, "one two"),
        (6, "one two"), (8, long_text), (8, long_text), (1, "Ünï çödé wörds É stay as they are " + BASE[40:120]),
        (None, "no id " + BASE), (10, BASE + " and a tail of some more words that nothing else has here at all"),
    ]


def documents(spark, rows=None):
    rows = awkward() if rows is None else rows
    full = [(i, t, "en", f"s{k % 2}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def clashing(df, *names):
    """``df`` with further columns of the given names."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("clash").alias(n) for n in names))


def shingles(text, lower=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def component_ids(rows, share):
    """Smallest id reachable over links of at least ``share`` hundredths, by position."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= share * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(rows[k][0], len(sets[k]), least.get(find(k))) for k in range(len(rows))]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def without_repeats(rows, width=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha of what is left) by looking at every string."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out, k = set(), [], 0
    while k < len(ordered):
        group = [r for r in ordered[k:] if r[0] == ordered[k][0]]
        k += len(group)
        fresh = set()
        for i, t in group:
            b = (t or "").encode()
            gone = bytearray(len(b))
            for p in range(len(b) - width + 1):
                if b[p:p + width] in seen:
                    gone[p:p + width] = b"\x01" * width
                fresh.add(b[p:p + width])
            spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
            out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
        seen |= fresh
    return out


def hits(text, items, width=10):
    """(n_words, hit positions, items) of a text against (item_id, text) rows."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = pattern.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        asked = pattern.findall((t or "").translate(LOWER))
        for k in range(max(1, len(asked) - width + 1)) if asked else ():
            window = asked[k:k + width]
            for p in range(len(words) - len(window) + 1):
                if words[p:p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.add("" if item is None else str(item))
    return len(words), hit, sorted(found)
