"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments (digit groups, separators, checks,
neighbouring characters) rather than single tokens.  Dynamic programming over
segments of at most MAX_TOKENS tokens (a parameter) chooses boundaries and kinds jointly and
gives their posterior probabilities; found patterns are held fixed.  It works on
places with digits, "@" or a written-out "at" or "dot", since no entity can lie
elsewhere.  It is there for what the patterns miss: it is fitted on a bounded
sample of places of the corpus, with the patterns as labels, and on examples of
disguised entities (blanks and line breaks inside, other separators, a missing
plus, local numbers of several countries, "[at]", " dot ") and of look-alikes
(dates, clocks, scores, sums, lists), which are made by rule.
"""

from __future__ import annotations

import math
import random
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import ship, small_batches, tidy, unpack

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 32
#: Places of the corpus and made examples that the field is fitted on, about, and the posterior that an added span needs.
SAMPLE_PLACES, MADE, SURE = 1500, 3200, 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_PLACE = re.compile(r"[0-9@]+|[(\[{<] ?(?i:at|dot|\.) ?[)\]}>]|(?<=\s)(?i:dot)(?=\s)|(?<=\s)(?i:at)(?=\s[A-Za-z0-9-]+\.[A-Za-z])")
_MARK_WORD = re.compile(r"@|\.|[(\[{<]?(?i:at|dot|\.)[)\]}>]?")
_WORD = re.compile(r"\S+")
_AT = r"(?:\s?@\s?|\s?[(\[{<] ?(?i:at) ?[)\]}>]\s?|\s(?i:at)\s)"
_DOT = r"(?:\s?\.\s?|\s?[(\[{<] ?(?i:dot|\.) ?[)\]}>]\s?|\s(?i:dot)\s)"
_LOOSE_EMAIL = re.compile(rf"[A-Za-z0-9][A-Za-z0-9._%+-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind as listed, then by start."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            end = found.end()
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) < 9 and int(p) <= 255 or p.strip("0") == "" or len(p.lstrip("0")) < 4 and int(p.lstrip("0")) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def places(text: str, gap: int = 3):
    """(start, end) of the stretches around digits and marks, widened to blanks and past mark words, nearby ones joined."""
    out: list[list[int]] = []
    for m in _PLACE.finditer(text):
        a, b = m.start(), m.end()
        if out and a < out[-1][1]:
            continue
        low = out[-1][1] if out else 0
        a, b = _begin(text, a, low), _end(text, b)
        bare = not m[0].isdigit()
        alone = (bare and "@" not in m[0] and a == m.start(), bare and "@" not in m[0] and b == m.end())
        while bare and a > low:  # a word is taken in next to a mark word
            before = _end_before(text, a, low)
            if before is None:
                break
            at = _begin(text, before, low)
            if not ((alone[0] and a == m.start()) or text[a] == "@" or _MARK_WORD.fullmatch(text, a, _end(text, a)) or _MARK_WORD.fullmatch(text, at, before)):
                break
            a = at
        while bare:
            after = _WORD.search(text, b, b + 3)
            if not after:
                break
            till = _end(text, after.start())
            if not ((alone[1] and b == m.end()) or text[b - 1] == "@" or _MARK_WORD.fullmatch(text, max(a, _begin(text, b, a)), b) or _MARK_WORD.fullmatch(text, after.start(), till)):
                break
            b = till
        if out and a - out[-1][1] <= gap:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [tuple(p) for p in out]


def _begin(text, a, low):
    while a > low and not text[a - 1].isspace():
        a -= 1
    return a


def _end(text, b):
    found = _BLANK.search(text, b)
    return found.start() if found else len(text)


def _end_before(text, a, low):
    """The end of the word before a, at most two blanks away."""
    for end in (a - 1, a - 2):
        if end > low and not text[end - 1].isspace():
            return end
    return None


_BLANK = re.compile(r"\s")


def _sort(c: str) -> str:
    return "edge" if not c else "blank" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else "mark"


def segments(text: str, start: int, end: int, most: int = MAX_TOKENS):
    """Token bounds of a place and its candidate segments of ``most`` tokens (first token, last token + 1, kinds, features)."""
    bounds = [(start + m.start(), start + m.end()) for m in _TOKEN.finditer(text[start:end])]
    return bounds, _candidates(text, bounds, most)


def _candidates(text, bounds, most):
    alnum = lambda i: 0 <= i < len(text) and text[i].isalnum()
    for i, (a, _) in enumerate(bounds):
        if not (text[a].isalnum() or text[a] in "+(") or alnum(a - 1):
            continue
        digits, letters, at, before = 0, False, False, ""
        for j in range(i, min(len(bounds), i + most)):
            p, q = bounds[j]
            c = text[p]
            if c in "\r\t" or c == before == "\n":
                break
            before = c
            if c.isdigit():
                digits += q - p
            letters |= c.isalpha()
            at |= c == "@" or text[p:q].lower() == "at"
            if not c.isalnum() or alnum(q):
                continue
            if digits >= 4 and not letters and not at:
                yield i, j + 1, (1, 2, 3), segment_features(text, a, q)
            elif at and _LOOSE_EMAIL.fullmatch(text, a, q):
                yield i, j + 1, (0,), segment_features(text, a, q)


_DATE = re.compile(r"(?<![0-9])(?:(?:1[89]|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:1[89]|20)[0-9]{2})(?![0-9])")
_LABEL = re.compile(r"[A-Za-z0-9-]+$")


def segment_features(text: str, a: int, b: int) -> list[str]:
    span = text[a:b]
    if re.search("[A-Za-z]", span):
        return _mail_features(text, a, b, span)
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    between = sorted(set(re.findall("[^0-9]+", span[1:])))
    n = len(digits)
    size = next(s for s in (3, 7, 10, 15, 19, 10**9) if n <= s)
    shape = "-".join([str(len(g)) for g in groups[:6]])
    joined = "|".join(between)[:12]
    octets = len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups) and all("." in s for s in between)
    even = len(set(map(len, groups[:-1]))) == 1
    trunk = digits[0] == "0" and digits[1:2] != "0" and 7 <= n <= 12
    good = 16 <= n <= 19 and even and luhn(digits)
    marks = re.sub("[0-9]+", "", span)
    return [
        "one",
        f"digits<={size}",
        f"groups={min(len(groups), 6)}",
        f"between={joined}",
        f"unlike={min(len(between), 4)}",
        f"first={span[0] if span[0] in '+(' else 'digit'}",
        f"before={_sort(text[a - 1 : a])}",
        f"after={_sort(text[b : b + 1])}",
        f"plus={span[0] == '+' and 8 <= n <= 15}",
        f"luhn={good}",
        f"luhn={good} shape={shape} issuer={digits[0] in '3456'}",
        f"luhn={good} between={joined}",
        f"octets={octets}",
        f"shape={shape}",
        f"shape={shape} between={joined}",
        f"zeros={digits.startswith('00') and 9 <= n <= 15}",
        f"trunk={trunk}",
        f"trunk={trunk} n={n if 7 <= n <= 12 else 0}",
        f"trunk={trunk} between={joined}",
        f"date={bool(_DATE.search(span))}",
        f"clock={':' in marks} list={', ' in marks}",
        f"length<={next(s for s in (8, 12, 16, 20, 32, 10**9) if len(span) <= s)}",
    ]


def _mail_features(text, a, b, span):
    at = "@" if "@" in span else "bracket" if re.search(r"[(\[{<] ?at", span, re.I) else "word"
    words = len(re.findall(r"\sdot\s", span, re.I))
    dot = "bracket" if re.search(r"[(\[{<] ?(?:dot|\.)", span, re.I) else "word" if words else "."
    last = _LABEL.search(span)[0].lower()
    upper = bool(re.search(r"\s(?:AT|DOT)\s", span))
    return [
        "one",
        f"at={at}",
        f"dot={dot}",
        f"at={at} dot={dot} upper={upper}",
        f"dots={min(3, words + span.count('.') + len(re.findall('dot[)\\]}>]', span, re.I)))}",
        f"blanks={min(6, len(re.findall(chr(92) + 's', span)))}",
        f"top={last if len(last) <= 4 else len(last)}",
        f"top<={min(5, len(last))} alpha={last.isalpha()}",
        f"before={_sort(text[a - 1 : a])}",
        f"after={_sort(text[b : b + 1])}",
        f"length<={next(s for s in (8, 12, 16, 20, 32, 10**9) if len(span) <= s)}",
    ]


# Top-level domains that made addresses end in, besides made-up ones.
TOPS = ["com", "org", "net", "de", "fr", "uk", "it", "es", "nl", "eu", "io", "edu", "info", "ch", "at", "be", "ru", "pl"]


def _card(dice, good=True):
    own = str(dice.choice([3, 4, 5, 6])) + "".join(dice.choice("0123456789") for _ in range(14))
    return own + next(d for d in "0123456789" if luhn(own + d) == good)


def disguised(kind: str, dice: random.Random) -> str:
    """An entity of a kind in a form that its pattern does not find as a whole."""
    digits = lambda n: "".join(dice.choice("0123456789") for _ in range(n))
    some = lambda n: str(dice.randint(1, 9)) + digits(n - 1)
    name = lambda a, b: "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(dice.randint(a, b)))
    if kind == "email":
        local = name(2, 9) + dice.choice(["", "", dice.choice("._-") + name(1, 7), digits(2)])
        labels = [name(2, 9) for _ in range(dice.choice([1, 1, 1, 2]))] + [dice.choice(TOPS) if dice.random() < 0.75 else name(2, 3)]
        left, right = dice.choice(["()", "[]", "{}", "<>"])
        gap, inner = dice.choice(["", "", " "]), dice.choice(["", "", " "])
        wrapped = lambda word: f"{gap}{left}{inner}{word}{inner}{right}{gap}"
        at, dot = dice.choice([
            (dice.choice([" @ ", "@ ", " @", "@\n"]), "."), (wrapped("at"), "."), (wrapped("at"), wrapped("dot")), (" at ", " dot "), (" AT ", " DOT "), ("@", " dot "), ("@", wrapped(".")), ("@", wrapped("dot")), (wrapped("AT"), wrapped("DOT")), (" at ", "."),
        ])
        return local + at + dot.join(labels)
    if kind == "ip":
        odd = [" . ", ". ", " .", "[.]", "(.)"]
        marks = [dice.choice(odd)] * 3 if dice.random() < 0.5 else dice.sample([dice.choice(odd), dice.choice([".", dice.choice(odd)]), "."], 3)
        parts = [str(dice.choice([dice.randint(0, 255), dice.randint(0, 20), dice.choice([10, 127, 168, 172, 192])])) for _ in range(4)]
        return "".join(p + m for p, m in zip(parts, [*marks, ""]))
    if kind == "card":
        own = _card(dice)
        return dice.choice([".", "/", "  ", " - ", "\n", "_", ", ", " / "]).join(own[i : i + 4] for i in range(0, 16, 4))
    area, middle, last, mark = str(dice.randint(200, 999)), digits(3), digits(4), dice.choice(" -")
    pairs, country = [digits(2) for _ in range(4)], dice.randint(30, 49)
    return dice.choice([
        f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}", f"1 ({area}) {middle}-{last}", f"1-{area}-{middle}-{last}", f"00{country} {digits(1)} {' '.join(pairs)}", f"00{country} {some(2)} {digits(6)}",
        f"+{country}/{digits(1)}/{'/'.join(pairs)}", f"+1\n{area}\n{middle}-{last}", mark.join([f"0{some(1)}", *pairs]), mark.join([f"0{some(1)}", *pairs]), f"0{some(3)}{dice.choice(['/', ' / ', '-', ' '])}{some(dice.randint(5, 8))}", f"0{some(2)}{dice.choice(['/', ' / ', '-', ' '])}{some(dice.randint(5, 8))}",
        f"0{some(2)} {digits(4)} {last}", f"0{some(1)}{dice.choice('- ')}{digits(4)}{dice.choice('- ')}{last}", f"0{some(4)} {digits(6)}", f"0{some(3)} {digits(3)} {last}", f"(0{some(dice.randint(2, 4))}) {some(dice.randint(5, 8))}", f"(0{some(2)}) {digits(3)}-{digits(dice.randint(3, 5))}",
    ])


def look_alike(dice: random.Random) -> str:
    """Digits and marks that are no personal data."""
    digits = lambda n: "".join(dice.choice("0123456789") for _ in range(n))
    some = lambda n: str(dice.randint(1, 9)) + digits(n - 1)
    word = lambda: dice.choice(["look", "noon", "the", "home", "ten", "over", "line", "we", "met", "end", "last", "page"])
    bad, year, month, day = _card(dice, False), dice.randint(1800, 2099), dice.randint(1, 12), dice.randint(1, 28)
    clock, mark = f"{dice.randint(0, 23):02}:{dice.randint(0, 59):02}", dice.choice("-/.")
    date = dice.choice([f"{year}{mark}{month:02}{mark}{day:02}", f"{day:02}{mark}{month:02}{mark}{year}", f"{day}{mark}{month}{mark}{year % 100:02}"])
    score = lambda: f"{dice.randint(0, 25)}{dice.choice('-:')}{dice.randint(0, 25)}"
    return dice.choice([
        dice.choice([".", "/", "  ", " - ", " ", "-", "_"]).join(bad[i : i + 4] for i in range(0, 16, 4)), dice.choice([" . ", "[.]", "."]).join(str(dice.randint(256, 999)) for _ in range(4)),
        date, f"{date} {clock}", f"{date} {clock}:{digits(2)}", f"{date}, {clock}", f"{date}T{clock}:{digits(2)}", clock, f"{clock}:{digits(2)}", f"{clock}:{digits(2)},{digits(3)}", f"{clock} - {clock}", f"{year} - {year + 5}", f"{year}-{year + 4}", f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}",
        dice.choice([" ", ", "]).join(score() for _ in range(dice.randint(2, 5))), ", ".join(str(year + i) for i in range(4)), ", ".join(some(dice.randint(1, 2)) for _ in range(dice.randint(3, 6))), f"{some(3)}-{some(3)}",
        f"{digits(2)}.{digits(3)}.{digits(3)},{digits(2)}", f"{some(1)}.{digits(3)}.{digits(3)}", f"{some(1)} {digits(3)} {digits(3)}", f"{some(3)} {digits(3)} {digits(3)}", f"{some(1)} {digits(3)} {digits(3)},{digits(2)}", f"{digits(1)},{digits(3)},{digits(3)}", f"{some(2)},{digits(3)},{digits(3)}",
        f"{some(2)}.{digits(4)}, {some(1)}.{digits(4)}", f"0,{digits(1)} 0,{digits(2)} 0,{digits(3)}", f"0.{digits(dice.randint(4, 9))}", f"{some(1)}.{digits(dice.randint(4, 9))}", f"v{digits(1)}.{digits(1)}.{digits(2)}", f"{some(2)}.{digits(1)}.{digits(2)}", f"{some(2)}-{digits(3)}", f"{some(3)} x {some(3)}",
        f"at {digits(4)} dot {digits(3)}", f"{word()} at {word()} dot {word()}", f"{word()} at {word()} dot", f"{word()} at {word()}.{word().title()}", f"{word()} at {word()}.", f"look at the dot over the i {digits(2)}", f"see @ {digits(4)}", f"{digits(5)}", f"{some(8)}", f"{some(10)}", f"{digits(16)}", f"{some(3)} {digits(3)} {digits(4)}", f"({year}) {digits(3)}-{digits(3)}", f"{some(2)} {some(2)} {some(2)} {some(2)}",
    ])


def made_examples(n: int, seed: int = 1) -> list:
    """n texts as (text, start, end, gold) of their places: half of them with a disguised entity."""
    dice, out = random.Random(seed), []
    words = ["call", "the", "und", "pour", "is", "de", "mail:", "number", "from", "por", "a", "(see", "Tel."]
    for i in range(n):
        kind = i % 4 if i % 8 < 4 else None
        before, after = dice.choice(words) + " ", dice.choice(["", ".", ",", ")"]) + " " + dice.choice(words)
        span = disguised(KINDS[kind], dice) if kind is not None else look_alike(dice)
        text = before + span + after
        gold = [(kind, len(before), len(before) + len(span))] if kind is not None else []
        out += [(text, start, end, [g for g in gold if start <= g[1] and g[2] <= end]) for start, end in places(text)]
    return out


class Field:
    """Weights of segment features by kind; every token outside a segment scores its own weight."""

    def __init__(self, max_tokens=MAX_TOKENS):
        self.w: dict = {}
        self.max_tokens = max_tokens

    def score(self, kind, features):
        w = self.w
        return sum([w.get((kind, f), 0.0) for f in features])

    def lattice(self, text, start, end, fixed=(), learn=True):
        """(tokens, arcs by end): arcs (from, kind or None, score, features to learn from); fixed spans exclude what crosses them."""
        bounds, found = segments(text, start, end, self.max_tokens)
        arcs: list[list] = [[] for _ in range(len(bounds) + 1)]
        for i, (p, q) in enumerate(bounds):
            features = [f"out={_sort(text[p])}"]
            arcs[i + 1].append((i, None, self.score(None, features), features if learn else None))
        for i, j, kinds, features in found:
            p, q = bounds[i][0], bounds[j - 1][1]
            if any(p < e and s < q for _, s, e in fixed):
                continue
            for k in kinds:
                arcs[j].append((i, k, self.score(k, features), features if learn else None))
        return bounds, arcs

    @staticmethod
    def forward(arcs):
        alpha = [0.0]
        for into in arcs[1:]:
            values = [alpha[i] + s for i, _, s, _ in into]
            top = max(values)
            alpha.append(top + math.log(sum([math.exp(v - top) for v in values])))
        return alpha

    @staticmethod
    def backward(arcs):
        n = len(arcs) - 1
        beta = [-math.inf] * n + [0.0]
        for j in range(n, 0, -1):
            for i, _, s, _ in arcs[j]:
                a, b = beta[i], s + beta[j]
                top = max(a, b)
                beta[i] = top if a == -math.inf else top + math.log(math.exp(a - top) + math.exp(b - top))
        return beta

    def fit(self, examples, epochs=4, rate=0.5, shrink=1e-4):
        """examples: (text, start, end, [(kind number, start, end)]); ascent on the conditional likelihood with per-weight rates."""
        seen: dict = {}
        for _ in range(epochs):
            for text, start, end, gold in examples:
                bounds, arcs = self.lattice(text, start, end)
                index = {(k, s, e) for k, s, e in gold}
                inside = [any(s <= p < e for _, s, e in gold) for p, _ in bounds]
                alpha, beta = self.forward(arcs), self.backward(arcs)
                grad: dict = {}
                for j in range(1, len(arcs)):
                    for i, k, s, features in arcs[j]:
                        p = math.exp(min(0.0, alpha[i] + s + beta[j] - alpha[-1]))
                        is_gold = not inside[i] if k is None else (k, bounds[i][0], bounds[j - 1][1]) in index
                        if abs(is_gold - p) > 1e-4:
                            for f in features:
                                grad[k, f] = grad.get((k, f), 0.0) + is_gold - p
                for key, g in grad.items():
                    g -= shrink * self.w.get(key, 0.0)
                    seen[key] = seen.get(key, 0.0) + g * g
                    self.w[key] = self.w.get(key, 0.0) + rate * g / math.sqrt(seen[key] + 1e-8)
        return self

    def best(self, text, start, end, fixed=(), sure=SURE):
        """The segments of the best path that the field is sure of."""
        bounds, arcs = self.lattice(text, start, end, fixed, learn=False)
        if all(len(into) < 2 for into in arcs[1:]):
            return []
        score, back = [0.0], [None]
        for into in arcs[1:]:
            value, arc = max(((score[i] + s, (i, k, s)) for i, k, s, _ in into), key=lambda v: v[0])
            score.append(value)
            back.append(arc)
        alpha, beta = self.forward(arcs), self.backward(arcs)
        out, j = [], len(arcs) - 1
        while j:
            i, k, s = back[j]
            if k is not None and math.exp(min(0.0, alpha[i] + s + beta[j] - alpha[-1])) >= sure:
                out.append((KINDS[k], bounds[i][0], bounds[j - 1][1]))
            j = i
        return out[::-1]


def find_spans(text: str, field: Field) -> tuple[list, list]:
    """(base spans, all spans), each by kind as listed, then by start."""
    base = base_spans(text)
    if not _PLACE.search(text):
        return base, base
    added, order = [], sorted(base, key=lambda s: s[1])
    at = 0
    for start, end in places(text):
        while at < len(order) and order[at][2] <= start:
            at += 1
        fixed, i = [], at
        while i < len(order) and order[i][1] < end:
            fixed.append(order[i])
            i += 1
        # an entity that is left has four digits at least, or a mark
        rest = sum(len(m[0]) if m[0].isdigit() else 4 for m in _PLACE.finditer(text, start, end) if not any(s <= m.start() < e for _, s, e in fixed))
        if rest >= 4:
            added += field.best(text, start, end, fixed)
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def join_spans(spans) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def mask(text: str, spans) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans by that of the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _examples(batches):
    import pyarrow as pa

    for batch in batches:
        out = [[], [], []]
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            for start, end in places(text):
                gold = [(k, s, e) for k, s, e in base if start <= s and e <= end]
                low = max(0, start - 1)
                out[0].append(text[low : end + 1])
                out[1].append(start - low)
                out[2].append(join_spans([(k, s - low, e - low) for k, s, e in gold]))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], names=["place", "start", "gold"])


def fit(rows: DataFrame, sample: int = SAMPLE_PLACES, max_tokens: int = MAX_TOKENS) -> Field:
    """The field, from about ``sample`` places of the rows(doc_id, text), chosen by a hash of the place, and from made examples."""
    marked = rows.where(F.col("text").rlike("[0-9@]"))
    n = marked.count()
    share = int(1_000_000 * sample / max(1, n)) + 1
    chosen = marked.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share)
    found = chosen.mapInArrow(_examples, "place string, start int, gold string").distinct().withColumn("h", F.xxhash64("place", F.lit(9))).orderBy("h", "place", "start").limit(sample)
    examples = []
    for r in found.collect():
        gold = [s.split(":") for s in r[2].split(",") if s]
        text = r[0]
        end = len(text) - (1 if text and text[-1:].isspace() else 0)
        examples.append((text, r[1], end, [(KINDS.index(k), int(s), int(e)) for k, s, e in gold]))
    return Field(max_tokens).fit(examples + made_examples(MADE))


def _scan(shared, masked):
    def run(batches):
        import hashlib
        from collections import Counter

        import pyarrow as pa

        field = unpack(shared)
        for batch in batches:
            out = [[] for _ in range(6 + 1)]
            for text in batch.column(1):
                text = text.as_py() or ""
                base, spans = find_spans(text, field)
                n = Counter(k for k, _, _ in base)
                row = *(n[k] for k in KINDS), hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans), mask(text, spans) if masked else None
                for column, value in zip(out, row):
                    column.append(value)
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"] + ["text"] * masked
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out[: 6 + masked], types))], names=names)

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_masked: bool = False, sample: int = SAMPLE_PLACES, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (and the masked text) of every row of docs.

    Counts and base_sha256 are those of the patterns; spans holds all spans as
    kind:start:end in code points, by kind, then start.  Null texts count as
    empty and have no spans.  Repeated rows and null ids are scanned like any
    other; other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    field = fit(rows, sample, max_tokens)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", text string" * with_masked
    return rows.mapInArrow(tidy(_scan(ship(spark, field), with_masked)), schema)


def _mask(shared, text_at, size_at):
    def run(batches):
        import pyarrow as pa

        field = unpack(shared)
        for batch in batches:
            texts = [None if t is None else mask(t, find_spans(t, field)[1]) for t in batch.column(text_at).to_pylist()]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
            if size_at is not None:
                columns[size_at] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def mask_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", sample: int = SAMPLE_PLACES, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The rows of docs, all columns, with every span of personal_data masked; size_col, where there is one, becomes the new length."""
    spark = docs.sparkSession
    small_batches(spark)
    field = fit(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), sample, max_tokens)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None
    return docs.mapInArrow(tidy(_mask(ship(spark, field), docs.columns.index(text_col), size_at)), docs.schema)
