"""Plain versions of the operators' contracts, one document at a time."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from datetime import date, timedelta
from functools import lru_cache
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

from muara.llm.pseudonyms import BETWEEN_CARDS, CALLING_CODE, DIGITS, KINDS, PATTERN

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
VOCABULARY = ["the", "of", "and", "house", "über", "naïve", "tree", "river", "stone", "cloud", "quick", "brown", "fox", "été"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(VOCABULARY) + (str(rng.randrange(900)) if rng.random() < 0.5 else "") for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "\t", ", ", "  "]) for w in words)


def edge_rows() -> list[tuple]:
    shared = prose(1, 120)
    rows = [(i, prose(100 + i, 40 + 15 * i)) for i in range(12)]
    rows += [(20 + i, prose(200 + i, 70) + shared + prose(300 + i, 30)) for i in range(5)]  # one passage, other surroundings
    rows += [(30 + i, shared) for i in range(4)]  # exact copies
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "x"), (44, "a" * 3000), (45, "a" * 3000), (46, "word " * 400)]
    rows += [(47, "word " * 200 + shared[:300]), (48, "\x00\x1f odd \x85   blanks ﬁ 日本語 " + shared)]
    rows += [(50, shared), (50, shared), (50, prose(9, 80)), (51, prose(9, 80))]  # repeated row; one id, two texts
    rows += [(None, shared), (None, None), (None, prose(9, 80))]
    rows += [(60, prose(60, 30_000)), (61, prose(61, 300) + prose(60, 30_000)[40_000:90_000])]
    rows += [(70, prose(70, 90)), (71, prose(70, 89) + "changed")]
    return rows


def texts(rows) -> list[tuple]:
    return [(i, (t or "").encode()) for i, t in rows]


def without_windows(rows, size: int, units, join) -> list[tuple]:
    """(id, units, removed, runs, sha256) with every unit covered by a window of a smaller id removed."""
    first: dict = {}
    for i, t in texts(rows):
        if i is not None:
            u = units(t)
            for k in range(len(u) - size + 1):
                window = join(u[k : k + size])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, t in texts(rows):
        u = units(t)
        covered = [False] * len(u)
        for k in range(len(u) - size + 1) if i is not None else ():
            if first[join(u[k : k + size])] < i:
                covered[k : k + size] = [True] * size
        kept = join([x for x, c in zip(u, covered, strict=True) if not c])
        runs = sum(c and (k == 0 or not covered[k - 1]) for k, c in enumerate(covered))
        out.append((i, len(u), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def byte_units(rows):
    return without_windows(rows, 50, lambda t: [t[k : k + 1] for k in range(len(t))], b"".join)


def word_units(rows):
    return [(i, n, r, h) for i, n, r, _, h in without_windows(rows, 50, WORD.findall, b" ".join)]


def simhash(text: bytes, shingle: int = 4) -> int:
    words = WORD.findall(text.lower())
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows, distance: int = 4) -> list[tuple]:
    marked = [(i, simhash(t)) for i, t in texts(rows)]
    values = sorted({f for _, f in marked})
    group = {f: f for f in values}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    least: dict = {}
    for i, f in marked:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [(i, f"{f:016x}", least.get(root(f))) for i, f in marked]


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = defaultdict(list)
    for k in range(len(words) - 2):
        places[tuple(words[k : k + 3])].append(k)
    covered = {k + d for p in places.values() if len(p) > 1 for k in p for d in range(3)}
    n, chars = len(words), sum(map(len, words))
    symbols, dup = len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    letters = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words)
    own = 10 * symbols > n or 2 * dup > len(lines) or not 3 * n <= chars <= 12 * n or 5 * letters < 4 * n
    return n, chars, symbols, dup, len(covered), failed, not failed and not own


def token_pieces(rows, path: str, capacity: int = 2048) -> Counter:
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(path), Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            packed = b"".join(x.to_bytes(4, "little") for x in part)
            out[(i, piece, start, len(part), zlib.crc32(packed))] += 1
    return out


def phrase_places(text: str | None) -> tuple:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(parts)] == parts]
    at = [k for k, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def secret_base(text: str | None) -> tuple:
    text, spans = text or "", []
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.ASCII):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for rank, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 20), (2, "hex", r"[0-9a-f]+", 24)):
        spans += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    spans.sort()
    shown = ",".join(s for _, _, s in spans)
    count = Counter(k for _, k, _ in spans)
    return count[0], count[1], count[2], hashlib.sha256(shown.encode()).hexdigest(), shown


def vector_rows() -> list[tuple]:
    """(vec_id, embedding, label) with dropped, empty, short, tied, repeated, huge and extreme vectors."""
    rng = random.Random(11)
    vector = lambda n=32, spread=0.3: [rng.gauss(0, spread) for _ in range(n)]
    rows = [(i, vector(), i % 3 if i % 5 else None) for i in range(90)]
    rows += [(100, None, 1), (101, [None] * 32, 1), (102, [float("nan"), *vector(31)], 1), (103, [float("inf"), *vector(31)], 2)]
    rows += [(104, [], 1), (105, vector(7), None), (106, vector(33), 2), (None, vector(), 1), (None, rows[3][1], None)]
    rows += [(2, vector(), 0), (rows[4][0], rows[4][1], rows[4][2]), (107, rows[7][1], 5)]
    rows += [(108, [3.0e6, -2.5e7, *vector(30)], 1), (-5, [-1e5 - 0.3, *vector(31)], 1)]
    return rows


def vector_codes(rows, parts: int = 16, entries: int = 64, rounds: int = 2):
    """Rows (vec_id, code, error, label_error, sha256) in Python integers, one part and entry after the other."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    step = max(1, -(-max(len(r[1]) for r in kept) // parts))
    whole = [[math.floor(Fraction(x) * 256) for x in r[1]] + [0] * (step * parts - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[whole[k][p * step : (p + 1) * step] for k in order] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v in whole:
                members[nearest(v[p * step : (p + 1) * step], books[p])[1]].append(v[p * step : (p + 1) * step])
            for e, vs in members.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    found = [[nearest(v[p * step : (p + 1) * step], books[p]) for p in range(parts)] for v in whole]
    errors = [min(sum(d for d, _ in f), 2**63 - 1) for f in found]
    by_label = Counter()
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [
        (r[0], "".join(f"{e:02x}" for _, e in f), error, min(by_label[r[2]], 2**63 - 1), sha)
        for r, f, error in zip(kept, found, errors, strict=True)
    ]


LOWER_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_words(text: str | None) -> list[bytes]:
    return LOWER_WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def resampled(rows, target, max_words: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024):
    """(doc_id, n_features, weight, score, rank) with one CRC-32 for each feature."""

    def hashed(text):
        w = lower_words(text)
        return [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]

    given, wanted = Counter(), Counter()
    for _, text in rows:
        given.update(hashed(text))
    for text in target:
        wanted.update(hashed(text))
    s, t = given.total(), wanted.total()
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((given[b] + 1) * (t + buckets)))) for b in given}
    scored = []
    for i, text in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        f = hashed(text)
        weight = sum(gain[b] for b in f)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(f), weight, weight + noise, len(lower_words(text)) >= least))
    able = sorted((x for x in scored if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[2], x[1]))
    drawn = able[: len(able) * percent // 100]
    out = Counter((*x[:4], k + 1) for k, x in enumerate(drawn))
    return out + Counter((*x[:4], None) for x in (Counter(scored) - Counter(drawn)).elements())


def toxicity(text: str | None, values, bias: float, window: int, bits: int = 20, steps: int = 1 << 20) -> float:
    """The score of one text, n-gram by n-gram."""
    mask = 2**64 - 1

    def mixed(h):
        h = ((h ^ h >> 31) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ h >> 29) * 0x94D049BB133111EB) & mask
        return h ^ h >> 32

    def logit(word):
        marked = b"<" + word + b">"
        grams = [marked[i : i + n] for n in range(3, 7) for i in range(len(marked) - n + 1)]
        sums = [sum(mixed(b + 77_001) * pow(0x9E3779B97F4A7C15, j, 2**64) for j, b in enumerate(g)) & mask for g in grams]
        found = [int(values[mixed((h + len(g)) & mask) >> 64 - bits]) for h, g in zip(sums, grams, strict=True)]
        return round(sum(found) / len(found))

    x = [logit(w) for w in lower_words(text)]
    means = [sum(x[i : i + window]) / len(x[i : i + window]) for i in range(max(1, len(x) - window + 1))] if x else [0.0]
    return 1 / (1 + math.exp(-(max(means) / steps + bias)))


# ---------------------------------------------------------------- pseudonyms, one value after the other


def feistel(value: int, high: int, low: int, key: str, kind: str) -> int:
    a, b = divmod(value, low)
    for i in range(10):
        told = int(hashlib.sha256(f"{key}|{kind}|{i}|{a if i % 2 else b}".encode()).hexdigest()[:15], 16)
        a, b = (a, (b + told) % low) if i % 2 else ((a + told) % high, b)
    return a * low + b


def feistel_digits(digits: str, key: str, kind: str) -> str:
    half = len(digits) // 2
    return str(feistel(int(digits), 10**half, 10 ** (len(digits) - half), key, kind)).zfill(len(digits))


def feistel_text(text: str, key: str, kind: str) -> str:
    half = len(text) // 2
    a, b = text[:half], text[half:]

    def move(part: str, i: int, other: str) -> str:
        h = hashlib.sha512(f"{key}|{kind}|{i}|{len(text)}|{other}".encode()).digest()
        out = ""
        for k, c in enumerate(part):
            low, size = (48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26) if c.isupper() else (0, 0)
            out += chr((ord(c) - low + h[k % 64]) % size + low) if size else c
        return out

    for i in range(10):
        a, b = (a, move(b, i, a)) if i % 2 else (move(a, i, b), b)
    return a + b


def refilled(shape: str, fill: str) -> str:
    left = iter(fill)
    return "".join(next(left) if c.isdigit() or c.isupper() else c for c in shape)


def luhn(digits: str, doubled: int = 1) -> int:
    doubles = [int(c) * (2 if k % 2 == doubled else 1) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubles)


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


@lru_cache(1)
def late_days() -> list[date]:
    days = (date(1800, 1, 1) + timedelta(n) for n in range(27 * 5411))
    return [d for d in days if d.day > 12]


def new_date(value: str, key: str) -> str | None:
    if value[4] == "-":
        parts, shown = (value[:4], value[5:7], value[8:]), "%Y-%m-%d"
    else:
        mark = value[2]
        if value[5] != mark:
            return None
        parts, shown = (value[6:], value[3:5], value[:2]), f"%d{mark}%m{mark}%Y"
    try:
        n = (date(*map(int, parts)) - date(1800, 1, 1)).days
        if 0 <= n < 27 * 5411:
            return (date(1800, 1, 1) + timedelta(feistel(n, 27, 5411, key, "date"))).strftime(shown)
        return None
    except ValueError:
        if value[4] == "-":
            return None
    try:
        found = date(int(parts[0]), int(parts[2]), int(parts[1]))
    except ValueError:
        return None
    if not 1800 <= found.year < 2200:
        return None
    days = late_days()
    return days[feistel(days.index(found), 9, 9833, key, "late")].strftime(f"%m{mark}%d{mark}%Y")


def new_phone(value: str, key: str) -> str | None:
    spaced = re.match(r"\+[0-9]{1,3}(?=[ .(-])", value)
    code = (spaced or re.match(CALLING_CODE, value)).group() if value[0] == "+" else ""
    digits = re.sub("[^0-9]", "", value[len(code) :])
    return code + refilled(value[len(code) :], feistel_digits(digits, key, "phone")) if 9 <= len(digits) + len(code) <= 16 else None


def new_digits(value: str, key: str) -> str:
    groups = list(re.finditer("[0-9]+", value))
    out, gap, at, i = "", "", 0, 0
    between = lambda text: re.sub(BETWEEN_CARDS, lambda m: one_pseudonym(m.group(), key, ("date", "phone")), text)
    while i < len(groups):
        gap += value[at : groups[i].start()]
        for m in range(min(5, len(groups) - i), 0, -1):
            text = value[groups[i].start() : groups[i + m - 1].end()]
            digits = re.sub("[^0-9]", "", text)
            if all(len(g.group()) >= 4 for g in groups[i : i + m - 1]) and 13 <= len(digits) <= 19 and set(digits) != {"0"} and luhn(digits) % 10 == 0:
                body = feistel_digits(digits[:-1], key, "card")
                out, gap = out + between(gap) + refilled(text, body + str(-luhn(body, 0) % 10)), ""
                break
        else:
            m, gap = 1, gap + groups[i].group()
        at, i = groups[i + m - 1].end(), i + m
    return out + between(gap + value[at:])


def one_pseudonym(value: str, key: str, kinds=tuple(KINDS)) -> str:
    for kind in kinds:
        if not re.fullmatch(KINDS[kind], value):
            continue
        new = None
        if kind == "email":
            local, domain = value.split("@", 1)
            new = feistel_text(local, key, "email") + "@" + domain
        elif kind == "iban":
            plain = value.replace(" ", "")
            if mod97(plain[4:] + plain[:4]) == 1 and 15 <= len(plain) <= 34:
                body = feistel_text(plain[4:], key, "iban")
                new = refilled(value, plain[:2] + str(98 - mod97(body + plain[:2] + "00")).zfill(2) + body)
        elif kind == "date":
            new = new_date(value, key)
        elif kind == "address":
            octets = [int(o) for o in value.split(".")]
            if max(octets) <= 255:
                n = feistel(int.from_bytes(octets), 65536, 65536, key, "address")
                new = ".".join(str(b) for b in n.to_bytes(4))
        elif kind == "digits":
            new = new_digits(value, key)
        else:
            new = new_phone(value, key)
        return value if new is None else new
    return value


def pseudonymised(text: str | None, key: str) -> tuple[str | None, int, int]:
    """(new text, places met, places changed)."""
    if text is None:
        return None, 0, 0
    changed = []

    def new(m):
        out = one_pseudonym(m.group(), key)
        changed.append(out != m.group())
        return out

    out = re.sub(PATTERN, new, text)
    return out, len(changed), sum(changed)


def personal_texts(seed: int, n: int) -> list[str]:
    """Valid and broken values of every format, next to each other, to words and to other numbers."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        body = digits(rng.randrange(12, 19))
        number = body + (str(-luhn(body, 0) % 10) if rng.random() < 0.8 else "0")
        cut = rng.choice(["", " ", "-"])
        return cut.join(number[i : i + 4] for i in range(0, len(number), 4))

    def iban():
        country, size = rng.choice([("DE", 22), ("NO", 15), ("ES", 24), ("MT", 31), ("ZZ", 20), ("GB", 22)])
        body = (rng.choice(["", "ABCD", "NWBK"]) + digits(40))[: size - 4]
        plain = country + str(98 - mod97(body + country + "00")).zfill(2) + body
        return rng.choice(["", " "]).join(plain[i : i + 4] for i in range(0, size, 4))

    def day():
        d, m, y = rng.randrange(1, 32), rng.randrange(1, 15), rng.choice([1799, 1800, 1999, 2024, 2199, 2200])
        return rng.choice(["{1:04}-{2:02}-{3:02}", "{3:02}.{2:02}.{1:04}", "{2:02}/{3:02}/{1:04}", "{3:02}/{2:02}.{1:04}"]).format(0, y, m, d)

    made = [
        card, card, iban, day, day,
        lambda: ".".join(str(rng.randrange(300)) for _ in range(4)),
        lambda: rng.choice(["+1 (743) 555-3824", "743 555 3824", "+4915112345678", "+14155552671", "030-1234-5678", "+999123", "+1234567890123456"]),
        lambda: rng.choice(["Ann.B9@x.example.org", "a@b.c.d.e", "x@y", "é.ab+c@sub-1.example.com.", "A@b.c@d.e"]),
        lambda: digits(rng.randrange(1, 25)), lambda: " ".join(digits(rng.randrange(1, 6)) for _ in range(rng.randrange(1, 12))),
        lambda: rng.choice(["EUR", "units", "BIC", "x", "ISBN 978-3-16-148410-0", "日本", "12a", "0000 0000 0000 0000"]),
    ]
    return ["".join(rng.choice(made)() + rng.choice([" ", " ", ", ", "\n", "-", "", "(", ": "]) for _ in range(rng.randrange(1, 9))) for _ in range(n)]


def _normal_tail(z: float) -> float:
    return 1 / (1 + math.exp(min(700.0, 1.5976 * z + 0.070565663 * z**3)))


def random_encoding(token: str, encodings: dict) -> str | None:
    both = re.search("[a-z]", token) and re.search("[A-Z]", token)
    mixed = re.search("[A-Za-z]", token) and (re.search("[0-9]", token) or both)
    fits = [k for k, (pattern, _, _) in encodings.items() if re.fullmatch(pattern, token) and (mixed or k in ("lower26", "upper26"))]
    return fits[0] if fits else None


def random_p(token: str, alphabet: str) -> float:
    """Smallest of three p-values, times three, that the token is drawn evenly from its alphabet."""
    codes = [alphabet.index(c) for c in token.rstrip("=")]
    n, k = len(codes), len(alphabet)
    squares = sum((codes.count(c) - n / k) ** 2 / (n / k) for c in range(k))
    spread = 2 / (9 * (k - 1))
    chi = _normal_tail(((squares / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    side = [c >= k / 2 for c in codes]
    high, low = sum(side), n - sum(side)
    mean = 2 * high * low / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + sum(a != b for a, b in zip(side, side[1:], strict=False))
    by_runs = min(1.0, 2 * _normal_tail(abs((runs - mean) / math.sqrt(variance)))) if variance > 0 else 0.0
    middle = sum(codes) / n
    total = sum((c - middle) ** 2 for c in codes)
    cross = sum((a - middle) * (b - middle) for a, b in zip(codes, codes[1:], strict=False))
    serial = min(1.0, 2 * _normal_tail(abs((cross / total + 1 / n) * math.sqrt(n)))) if total > 0 else 0.0
    return min(1.0, 3 * min(chi, by_runs, serial))


def random_reported(tokens: list[str], encodings: dict, aside=0.01, wrong=0.05, steps=400, floor=1e-12) -> set[str]:
    """Tokens neither set aside as ordinary nor cut off to bound the ordinary ones among the reported."""
    classes: dict[tuple, list] = {}
    for token in tokens:
        name = random_encoding(token, encodings)
        if name:
            p = random_p(token, encodings[name][1])
            step = math.floor(-math.log10(max(p, floor)) / (-math.log10(floor) / steps))
            classes.setdefault((name, math.floor(math.log2(len(token)))), []).append((step, p, token))
    found = set()
    for members in classes.values():
        value = lambda step: 10 ** (step * math.log10(floor) / steps)
        known = sorted({m[0] for m in members})
        cut = min((s for s in known if value(s) <= sum(m[0] >= s for m in members) / len(members) * aside), default=math.inf)
        high = sum(m[0] < 10 for m in members)
        drawn = (high + 1 + math.sqrt(high)) / 0.64
        last = -1
        for s in known:
            reported = sum(m[0] <= s for m in members)
            if reported - drawn * (1 - value(s + 1)) <= wrong * reported:
                last = s
        found |= {t for s, _, t in members if s < cut and s <= last}
    return found
