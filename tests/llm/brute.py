"""Plain one-process versions of the query contracts, for small tables.

They share no code with the operators, but for the trigram cells of `fused_languages`.  Every function takes rows as lists of
(doc_id, text) and returns {doc_id: columns} or rows.
"""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter


def _tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


def token_ids(docs, name, end_id):
    t = _tokenizer(name)
    return {d: t.encode(x or "", add_special_tokens=False).ids + [end_id] for d, x in docs}


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def pieces(docs, capacity=1024, name="byte_bpe_50k.json", end_id=2):
    """{(doc_id, piece): (start, length, crc)}"""
    out = {}
    for d, ids in token_ids(docs, name, end_id).items():
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > first else \
            [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[d, k] = (a, b - a, crc(ids[a:b]))
    return out


def records(docs, name="word_bpe_49k.json", end_id=2):
    out, start = {}, 0
    for d, ids in sorted(token_ids(docs, name, end_id).items()):
        out[d] = (start, len(ids), crc(ids))
        start += len(ids)
    return out


def removed_bytes(docs, size=100):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256 of the rest)}"""
    seen, out = set(), {}
    for d, x in sorted(docs):
        b = (x or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            w = b[i:i + size]
            if w in seen:
                gone[i:i + size] = b"\1" * size
            seen.add(w)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contaminated(docs, items, size=13):
    windows = {}
    for item, x in items:
        w = re.findall(WORD, lower(x))
        if w:
            for i in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = {}
    for d, x in docs:
        w = re.findall(WORD, lower(x))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        text = ",".join(sorted(str(i) for i in found if i is not None))
        out[d] = (len(w), len(hit), len(found - {None}), hashlib.sha256(text.encode()).hexdigest(),
                  bool(hit) and 20 * len(hit) >= len(w))
    return out


PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"),
       ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii_base(docs):
    """{doc_id: (n_email, n_ip, n_card, n_phone, sha256, spans)}"""
    out = {}
    for d, x in docs:
        spans = []
        for k, (kind, pattern) in enumerate(PII):
            for m in re.finditer(pattern, x or ""):
                digits = re.sub(r"[^0-9]", "", m[0])
                if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                    continue
                if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                    continue
                if kind == "phone" and not 9 <= len(digits) <= 15:
                    continue
                spans.append((m.start(), k, m.end(), kind))
        text = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))
        n = Counter(s[3] for s in spans)
        out[d] = (n["email"], n["ip"], n["card"], n["phone"],
                  hashlib.sha256(text.encode()).hexdigest(), text)
    return out


def quality_base(docs):
    """{doc_id: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed)}"""
    out = {}
    for d, x in docs:
        x = x or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        dup = sum(y in lines[:i] for i, y in enumerate(lines))
        windows = Counter(zip(w, w[1:], w[2:]))
        hit = set()
        for i in range(len(w) - 2):
            if windows[tuple(w[i:i + 3])] > 1:
                hit |= {i, i + 1, i + 2}
        out[d] = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(hit),
                  len(w) < 50 or 100 * len(hit) > 50 * len(w))
    return out


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near(docs, percent=85):
    """{doc_id: (n_shingles, component_id)} by comparing all documents that
    share a shingle."""
    sets = {d: shingles(x) for d, x in docs}
    by_set = {}
    for d in sorted(sets):
        by_set.setdefault(sets[d], []).append(d)
    distinct = [s for s in by_set if s]
    holders = {}
    for i, s in enumerate(distinct):
        for g in s:
            holders.setdefault(g, []).append(i)
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(distinct):
        both = Counter(j for g in s for j in holders[g] if j < i)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(distinct[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, s in enumerate(distinct):
        r = find(i)
        least[r] = min(least.get(r, by_set[s][0]), by_set[s][0])
    out = {d: (0, d) for d in by_set.get(frozenset(), [])}
    for i, s in enumerate(distinct):
        for d in by_set[s]:
            out[d] = (len(s), least[find(i)])
    return out


def fused_languages(docs, pages):
    """{page_id: (lang, confidence, text_lang)} by the formula, page by page.  ``docs``:
    (lang, text); ``pages``: (page_id, host, domain, suffix, declared, visible text)."""
    from seatcast.llm import langid

    counts = {}
    for lang, text in docs:
        if lang:
            counts.setdefault(lang, Counter()).update(langid.trigrams(text or "").tolist())
    langs = sorted(x for x, c in counts.items() if c)
    size = {x: sum(counts[x].values()) for x in langs}
    average = Counter()
    for x in langs:
        for c, n in counts[x].items():
            average[c] += n / size[x] / len(langs)

    def log(x, c):
        if c not in average:
            return 0.0
        base = langid.SMOOTHING * (0.9 * average[c] + 0.1 / langid.CELLS)
        return math.log((counts[x][c] + base) / (size[x] + langid.SMOOTHING))

    text_log, share = {}, {}
    for page_id, *_, text in pages:
        cells = langid.trigrams(text).tolist()
        n = max(len(cells), 1)
        logs = [sum(log(x, c) for c in cells) for x in langs]
        own = [(v - max(logs)) * min(n / langid.TEMPER, langid.MAX_EVIDENCE) / n for v in logs]
        mass = sum(map(math.exp, own))
        text_log[page_id] = own
        share[page_id] = [round(math.exp(v) / mass * 10**6) for v in own]
    micro, out = 10**6, {}
    for page_id, *values, _ in pages:
        others = [p for p in pages if p[0] != page_id]

        def summed(column, value):
            return [sum(share[p[0]][k] for p in others if column is None or p[column] == value)
                    for k in range(len(langs))]

        host, domain, suffix, declared = values
        all_pages = summed(None, None)
        everything = max(sum(map(sum, share.values())) - micro, micro)
        score = text_log[page_id][:]
        for column, value in ((4, declared), (3, suffix)):
            mine = summed(column, value)
            base = (sum(mine) + micro) / (everything + micro)
            for k in range(len(langs)):
                score[k] += math.log((mine[k] + micro * base) / (all_pages[k] + micro))
        prior = [(v + micro) / (sum(map(sum, share.values())) - micro + len(langs) * micro)
                 for v in all_pages]
        for column, value in ((2, domain), (1, host)):
            mine = summed(column, value)
            prior = [(v + langid.HOST_SMOOTHING * micro * p)
                     / (sum(mine) + langid.HOST_SMOOTHING * micro)
                     for v, p in zip(mine, prior, strict=True)]
        score = [s + math.log(p) for s, p in zip(score, prior, strict=True)]
        best = max(score)
        own = share[page_id]
        out[page_id] = (langs[score.index(best)], 1 / sum(math.exp(s - best) for s in score),
                        langs[own.index(max(own))])
    return out
