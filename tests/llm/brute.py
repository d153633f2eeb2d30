"""Brute-force versions of the corpus operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SECRET_PATTERNS = (
    ("assign", re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text):
    """[(start, kind order, end)] of the base kinds."""
    out = []
    for order, (kind, pattern) in enumerate(SECRET_PATTERNS):
        for m in pattern.finditer(text or ""):
            size = len(m[1]) if kind == "assign" else m.end() - m.start()
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), order, m.end()))
    return sorted(out)


def secret_row(text):
    spans = base_secrets(text)
    n = Counter(s[1] for s in spans)
    names = [k for k, _ in SECRET_PATTERNS]
    return n[0], n[1], n[2], sha256(",".join(f"{names[o]}:{a}:{b}" for a, o, b in spans))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def contamination(docs, items, span=10):
    """{row number: (n_words, n_hit, items)} for texts and (id, text) items."""
    windows = defaultdict(set)
    for item, text in items:
        ws = words(text)
        m = min(span, len(ws))
        for i in range(len(ws) - m + 1 if m else 0):
            windows[tuple(ws[i:i + m])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for row, text in enumerate(docs):
        ws, hit, found = words(text), set(), set()
        for m in lengths:
            for i in range(len(ws) - m + 1):
                got = windows.get(tuple(ws[i:i + m]))
                if got:
                    hit.update(range(i, i + m))
                    found |= got
        out[row] = (len(ws), len(hit), sorted(found))
    return out


def minimax(sizes, shards):
    """Smallest capacity for contiguous runs of ``sizes`` (greedy check of every candidate)."""
    low, high = max(sizes, default=0), sum(sizes)

    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def crc32(text):
    return zlib.crc32((text or "").encode())


def fingerprint(text, width=4):
    import xxhash

    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + width]) for i in range(len(ws) - width + 1)] or [" ".join(ws)]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(ids, fps, bits=4):
    """Smallest id reachable from each place (null ids never name one)."""
    top = list(range(len(ids)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                top[find(i)] = find(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)].append(x)
    return [min(least[find(i)], default=None) for i in range(len(ids))]


def repeats(texts, width=200):
    """[(bytes, removed, runs, kept)] of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i:i + width] for x in raw for i in range(len(x) - width + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - width + 1):
            if seen[x[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        runs = sum(1 for i in range(len(x)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(x), sum(gone), runs, bytes(b for b, g in zip(x, gone) if not g)))
    return out


def best_cuts(at, penalty, window):
    """Least cost of cutting at ``at`` (all predecessors tried)."""
    best = [0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        best[j] = min(best[i] + (0 if (n := at[j] - at[i]) & (n - 1) == 0 else window - n)
                      for i in range(j) if at[j] - at[i] <= window) + penalty[j]
    return best[-1]


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergences(rows, least=10, top=10):
    """[(lang, source, part, item, value, rank)] of (lang, source, text) rows."""
    documents, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        documents[lang].update(set(terms))
        counts[lang, source].update(terms)

    def far(p, q):
        return (p - q) * (p - q) // (p + q)

    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = sorted((-sum(far(p[s][t], p[u][t]) for t in kept), u.encode(), u) for u in sources if u != s)
            terms = sorted((-far(p[s][t], q[t]), t.encode(), t) for t in kept
                           if counts[lang, s][t] > 0 and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def token_groups(text):
    """[(ids of A, ids of B)] of a text, byte by byte; None without tokens."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    if "a" not in _VOCABULARIES:
        a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        a.encode_special_tokens = True
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in own}
        letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
        _VOCABULARIES.update(a=a, letters=letters, b=sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path("piece_bpe_32k.model")))
    a, b, letters = (_VOCABULARIES[k] for k in ("a", "b", "letters"))
    if not text:
        return None

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode()

    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, piece(i)) for i in b.encode(text)]
    raw = b" " + text.encode()
    if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
        return None
    ends = [set(), set()]
    for side, tokens in enumerate((left, right)):
        at = 0
        for _, x in tokens:
            at += len(x)
            ends[side].add(at)
    both = ends[0] & ends[1]
    out = [[], []]
    for side, tokens in enumerate((left, right)):
        at, own = 0, []
        for i, x in tokens:
            own.append(i)
            at += len(x)
            if at in both:
                out[side].append(own)
                own = []
    return list(zip(*out))


_VOCABULARIES: dict = {}


def alignments(texts):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, digest)] of each text."""
    groups = [token_groups(t) or [] for t in texts]
    links = [Counter((u, v) for x, y in g for u in x for v in y) for g in groups]
    count = Counter(k for c in links for k in c)
    top = defaultdict(int)
    for (u, _), n in count.items():
        top[u] = max(top[u], n)
    out = []
    for g, c in zip(groups, links):
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for k, n in c.items() if count[k] == top[k[0]]), sum(n * count[k] for k, n in c.items()),
                    sha256(line) if g else ""))
    return out


def first_fit_decreasing(sizes, window):
    """Number of bins (a plain first fit, longest first)."""
    room = []
    for s in sorted(sizes, reverse=True):
        for i, r in enumerate(room):
            if s <= r:
                room[i] -= s
                break
        else:
            room.append(window - s)
    return len(room)


def gram_counts(text, buckets=4096, salts=(2654435761, 2246822519, 3266489917)):
    """Hashed 1- to 3-gram counts of a text's lower-cased letters, one by one."""
    mask = (1 << 32) - 1
    line = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
    codes, out = [ord(c) for c in line], Counter()

    def two(i):
        return ((codes[i] * salts[0] & mask) ^ (codes[i + 1] * salts[1] & mask)) * salts[2] & mask

    for i, c in enumerate(codes):
        if c != 32:
            out[(c * salts[0] & mask) >> 20] += 1
        if i + 1 < len(codes):
            out[two(i) >> 20] += 1
        if i + 2 < len(codes) and codes[i + 1] != 32:
            out[((two(i) ^ (codes[i + 2] * salts[0] & mask)) * salts[1] & mask) >> 20] += 1
    return out, sum(c != 32 for c in codes)
