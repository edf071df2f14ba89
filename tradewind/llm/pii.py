"""Personal data: exact patterns, and further candidates judged by gradient-boosted trees.

The base patterns are kept as they are. Generators with a high recall propose more spans, which may overlap: written-out
mail addresses, national phone numbers, social security numbers, bank accounts, credentials (named, in links, or of a known
make), IPv6 and MAC addresses, street addresses, names, days of birth, passports. Boosted trees judge each by its
format and its context; they learn from examples made by the templates below, are calibrated on examples held back, and a
span is taken from the lowest probability at which those were right ``PRECISION`` of the time, half way to the next one below.
"""

from __future__ import annotations

import ipaddress
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm.common import map_texts

#: kinds in the order of their listing; the first four are the base
KINDS = ("email", "ip", "card", "phone", "secret", "ssn", "iban", "ipv6", "mac", "address", "name", "birth", "passport")
PRECISION = 0.98
CONTEXT = 32
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match never begins within a run of digits, as the run's first digit would have matched too
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted; leftmost, without overlaps within a kind."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        low = last + len(text[last:at].rstrip(_LOCAL))
        hit = _DOMAIN.match(text, at) if low < at else None
        last = hit.end() if hit else at + 1
        if hit:
            out.append((low, 0, last))
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


#: what stands for the @ of an address, without what closes it
_AT = re.compile(r"@|[(\[{ ] ?at(?=[)\]} ]| [)\]}])|[(\[{] ?@(?= ?[)\]}])", re.I)
_LABELS = r"[A-Za-z0-9-]++(?:(?:{0})[A-Za-z0-9-]++){{0,125}}(?:{0})[A-Za-z0-9-]{{2,}}+"
_DOT = r" ?[(\[{ ] ?dot ?[)\]} ] ?"
#: next to brackets a dot may have blanks around it; elsewhere a blank after it begins a sentence
_TIGHT = re.compile(r" ?(?:[)\]} ] ?)?" + _LABELS.format(rf"\.|{_DOT}"), re.I)
_LOOSE = re.compile(r" ?[)\]} ] ?" + _LABELS.format(rf" ?\.| \. |\. (?=(?-i:com|org|net|edu|gov|info|[a-z]{{2}})\b)|{_DOT}"), re.I)
_DOTTED = re.compile(_DOT, re.I)
_NATIONAL = re.compile(r"(?<![\w+.,-])(?:\(\d{2,5}\) ?|\d{2,5}[ ./-])\d{3,4}[ .-]?\d{2,5}(?![\w-])")
_SSN = re.compile(r"(?<![\w-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: what is named a credential by a sign, or said to be one
_NAMED = re.compile(r"(?:token|secret|key|pass(?:word|wd|phrase|code)|pwd|\bpin|auth|bearer)"
                    r"(?:[\"']? ?[:=] ?[\"']?([^\s\"']{8,}+)| (?:is|was) [\"']?([^\s\"']{6,}+))", re.I)
_HEX = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])")


#: makes of keys and tokens that need no name before them
_MADE = re.compile(r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|xox[abeoprs]-[A-Za-z0-9-]{10,}+|gh[opsu]_[A-Za-z0-9]{20,}+|"
                   r"github_pat_[A-Za-z0-9_]{20,}+|glpat-[A-Za-z0-9_-]{20,}+|sk[-_][A-Za-z0-9_-]{20,}+|AIza[0-9A-Za-z_-]{35}+|"
                   r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++)?)")
_LINK = re.compile(r"://[^\s/@:\"'<>]*+:([^\s/@\"'<>]++)@")
_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*+-----")
_COLONS = re.compile(r":[0-9a-fA-F]{0,4}:[0-9a-fA-F:.]*+")
_MAC = re.compile(r"[0-9a-fA-F]{2}(?:([:-])[0-9a-fA-F]{2})(?:\1[0-9a-fA-F]{2}){4}")
_DASHED = re.compile(r"-(?:[0-9a-fA-F]{2}-){4}[0-9a-fA-F]{2}(?![0-9A-Za-z-])")
_UPPER, _LOWER = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_PROPER = rf"[{_UPPER}][{_LOWER}]++(?:[-'’][{_UPPER}][{_LOWER}]++)?"
_STREET = re.compile(
    rf"(?<![\w.,/-])\d{{1,5}}[A-Za-z]? (?:(?:[NSEW]\.? )?(?:{_PROPER}|\d{{1,3}}(?:st|nd|rd|th)) ){{1,4}}?"
    r"(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Dr|Court|Ct|Place|Pl|Square|Sq|Way|Terrace|Crescent|Highway|Hwy)\b\.?"
    rf"(?:,? (?:Apt|Apartment|Suite|Unit|Flat|#)\.? ?\w{{1,6}})?(?:, {_PROPER}(?: {_PROPER})?)?(?:,? [A-Z]{{2}})?(?:,? \d{{5}}(?:-\d{{4}})?\b)?")
#: the number after the street
_STRASSE = re.compile(rf"(?<!\w)[{_UPPER}][{_LOWER}]*?(?:straße|strasse|str\.|weg|platz|gasse|allee) \d{{1,4}}[a-z]?(?!\w)(?:, \d{{5}} {_PROPER})?")
#: words one of which must be in a text before its pattern is tried
_NAMES = ((("ame is ",), re.compile(rf"ame is ({_PROPER}(?: (?:{_PROPER}|[{_UPPER}]\.)){{0,3}})")),
          (("ame",), re.compile(rf"ame ?[:=] ?[\"']?({_PROPER}(?: (?:{_PROPER}|[{_UPPER}]\.)){{1,3}})")),
          (("Mr", "Ms", "Miss", "Dr", "Prof"),
           re.compile(rf"(?<!\w)(?:Mr|Mrs|Ms|Miss|Dr|Prof)\b\.? ({_PROPER}(?: (?:{_PROPER}|[{_UPPER}]\.)){{0,3}})")),
          (("atient", "lient", "ustomer", "mployee", "pplicant", "enant", "older", "igned by"),
           re.compile(rf"(?<!\w)(?:(?:patient|client|customer|employee|applicant|tenant|holder|signed by)"
                      rf"|(?:[Pp]atient|[Cc]lient|[Cc]ustomer|[Ee]mployee|[Aa]pplicant|[Tt]enant|[Hh]older|[Ss]igned by):) ({_PROPER}(?: {_PROPER}){{1,2}})")))
_DATE = re.compile(r"(?<![\w./-])(?:\d{1,2}([./-])\d{1,2}\1(?:19|20)?\d{2}|(?:19|20)\d{2}-\d{2}-\d{2})(?![\w/-])")
_PASSPORT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}\d{6,9}(?![A-Za-z0-9])")
_HEXDIGITS = "0123456789abcdefABCDEF"


def _colon_groups(text: str):
    """(start, kind, end) of groups of hex digits between colons: MAC and IPv6 addresses, and times of day."""
    for m in _COLONS.finditer(text):
        low = m.start() - 5
        low = max(0, low) + len(text[max(0, low):m.start()].rstrip(_HEXDIGITS))
        span = text[low:m.end()].rstrip(".")
        if span.endswith(":") and not span.endswith("::"):
            span = span[:-1]
        end = low + len(span)
        if not (text[low - 1:low].isalnum() or text[end:end + 1].isalnum() or text[low - 1:low] in (":", ".") and low):
            out = 8 if _MAC.fullmatch(span) else 7
            yield low, out, end


def _key_blocks(text: str):
    """(start, kind, end) of private keys between their first and last line."""
    at = text.find("-----BEGIN ")
    while at >= 0:
        head, close = _BLOCK.match(text, at), text.find("-----END ", at)
        if close < 0:
            return
        end = text.find("-----", close + 9)
        end = end + 5 if end >= 0 else len(text)
        if head and "PRIVATE KEY" in head[0]:
            yield at, 4, end
        at = text.find("-----BEGIN ", end)


def candidates(text: str) -> set[tuple[int, int, int]]:
    """(start, kind, end) of everything that might be personal data; spans may overlap."""
    out = set()
    last = 0
    for m in _AT.finditer(text):
        at = m.start() - (text[m.start() - 1:m.start()] == " ")
        low, last = last + len(text[last:at].rstrip(_LOCAL)), m.start() + 1
        tail = (_LOOSE if m[0][0] in "([{" else _TIGHT).match(text, m.end()) if low < at else None
        # the base has the addresses with a plain @
        apart = m[0] != "@" or (at < m.start() and text[m.end():m.end() + 1] == " ")
        if tail and (apart or _DOTTED.search(tail[0])):
            out.add((low, 0, tail.end()))
    for kind, pattern in ((3, _NATIONAL), (5, _SSN), (6, _IBAN), (4, _HEX)):
        out.update((m.start(), kind, m.end()) for m in pattern.finditer(text))
    for pattern in (_NAMED, _LINK):
        out.update((m.start(m.lastindex), 4, m.end(m.lastindex)) for m in pattern.finditer(text))
    for kind, pattern in ((4, _MADE), (9, _STREET), (11, _DATE), (12, _PASSPORT)):
        out.update((m.start(), kind, m.end()) for m in pattern.finditer(text))
    if any(w in text for w in ("str", "weg", "platz", "gasse", "allee")):
        out.update((m.start(), 9, m.end()) for m in _STRASSE.finditer(text))
    for words, pattern in _NAMES:
        if any(w in text for w in words):
            out.update((m.start(1), 10, m.end(1)) for m in pattern.finditer(text))
    for m in _DASHED.finditer(text):
        head = text[max(0, m.start() - 3):m.start()]
        if len(head) >= 2 and all(c in _HEXDIGITS for c in head[-2:]) and not (len(head) == 3 and (head[0].isalnum() or head[0] == "-")):
            out.add((m.start() - 2, 8, m.end()))
    out.update(_colon_groups(text))
    out.update(_key_blocks(text))
    return out


#: words before a span that speak for each kind, and words that speak against any
FOR = {0: ("mail", "contact", "write to", "reach"), 3: ("phone", "call", "tel", "mobile", "fax", "contact", "reach", "dial"),
       4: ("token", "secret", "key", "password", "passwd", "pwd", "auth", "bearer"), 5: ("ssn", "social security", "tax id"),
       6: ("iban", "account", "bank", "transfer"), 7: ("ip", "address", "host", "from", "inet", "client"),
       8: ("mac", "ether", "hardware", "device", "address"), 9: ("address", "live", "resid", "ship", "home", "deliver", "mail"),
       10: ("name is", "name:", "name=", "patient", "client", "customer", "employee", "applicant", "tenant", "holder", "signed"),
       11: ("born", "birth", "dob"), 12: ("passport",)}
AGAINST = ("version", "order", "invoice", "isbn", "page", "section", "figure", "serial", "model", "part no", "sha", "md5", "commit",
           "checksum", "date", "score", "price", "ratio", "pages", "law", "act")


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT):start].lower(), text[end:end + CONTEXT].lower()
    digits, n = _digits(span), max(1, end - start)
    counts = Counter(span)
    groups = [len(g) for g in re.findall(r"\d+", span)]
    iban, made = 0, 0
    if kind == 4:
        made = bool(_MADE.match(span) or span.startswith("-----BEGIN")) + 2 * (before[-1:] == ":" and after[:1] == "@")
    if kind == 7:
        try:
            iban = bool(ipaddress.IPv6Address(span))
        except ValueError:
            pass
    if kind == 6:
        flat = span.replace(" ", "")
        iban = int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
    return [*(kind == k for k in FOR), n, len(digits), len(digits) / n, sum(c.isupper() for c in span) / n,
            -sum(c / n * math.log2(c / n) for c in counts.values()), len(counts) / n, len(groups), max(groups, default=0),
            groups[-1] if groups else 0, any(w in before for w in FOR[kind]), any(w in before for w in AGAINST),
            any(w in after for w in AGAINST), span.count("-"), span.count(" "), span.count("."), "(" in span or "[" in span,
            bool(iban), made, digits[:3] in ("000", "666") or digits[:1] == "9", before[-1:] in "\"'=:", before[-2:] == ". "]


def examples(seed: int = 7, each: int = 160) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, truth and kind of spans that templates make; half of them personal data."""
    rng = np.random.default_rng(seed)

    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    def num(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def hexes(n):
        return "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, n))

    def word():
        return "".join("abcdefghiklmnoprstuvw"[i] for i in rng.integers(0, 21, int(rng.integers(2, 9))))

    def bank():
        body = num(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    def grouped(x):
        return " ".join(x[i:i + 4] for i in range(0, len(x), 4))

    def name():
        return f"{word()}{pick(['.', '_', ''])}{word()}"

    def proper():
        return word().capitalize()

    def person():
        return f"{proper()} {pick(['', '', pick('ABCDEFGHJKLM') + '. '])}{proper()}"

    def street():
        return pick([f"{rng.integers(1, 9999)} {proper()} {pick(['Street', 'St', 'Avenue', 'Road', 'Lane', 'Drive', 'Blvd'])}"
                     f"{pick(['', f', {proper()}', f', {proper()}, TX {num(5)}', f', Apt {rng.integers(1, 99)}'])}",
                     f"{proper()}{pick(['straße', 'strasse', 'weg', 'platz', 'allee'])} {rng.integers(1, 200)}{pick(['', f', {num(5)} {proper()}'])}"])

    def date():
        y, m, d = rng.integers(1930, 2022), rng.integers(1, 13), rng.integers(1, 29)
        return pick([f"{d:02d}.{m:02d}.{y}", f"{m}/{d}/{y}", f"{y}-{m:02d}-{d:02d}", f"{d}-{m}-{y}"])

    def groups(n):
        return ":".join(hexes(4).lstrip("0") or "0" for _ in range(n))

    def clock():
        return f"{rng.integers(0, 24):02d}:{rng.integers(0, 60):02d}:{rng.integers(0, 60):02d}"

    real = {0: lambda: f"{name()} {pick(['(at)', '[at]', 'at'])} {word()} {pick(['(dot)', '[dot]', 'dot'])} {pick(['com', 'org', 'net', 'de'])}",
            3: lambda: pick([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"0{num(2)} {num(4)} {num(4)}", f"0{num(3)}/{num(3)}{num(3)}"]),
            4: lambda: pick([hexes(32), hexes(40), hexes(64), f"sk-{hexes(28)}", word().title() + num(4) + "!" + word()]),
            5: lambda: f"{rng.integers(100, 665)}-{num(2)}-{num(4)}", 6: lambda: pick([bank(), grouped(bank())]),
            7: lambda: pick([groups(8), f"fe80::{groups(4)}", f"2001:db8::{groups(int(rng.integers(1, 5)))}", f"{groups(3)}::{hexes(2)}"]),
            8: lambda: pick([":", "-"]).join(hexes(2) for _ in range(6)), 9: street, 10: person, 11: date,
            12: lambda: pick([f"{pick('ABCDEFGHKLMNPX')}{num(int(rng.integers(7, 9)))}", f"{pick('ABCDEFGHKLMNPX')}{pick('ABCDEFGHKLMNPX')}{num(7)}"])}
    fake = {0: lambda: f"{word()} at {word()} dot {word()}", 3: lambda: pick([f"{num(2)} {num(3)} {num(3)}", f"{num(4)}-{num(4)}", f"{num(3)}.{num(3)}.{num(2)}", f"{num(3)} {num(4)}"]),
            4: lambda: pick([hexes(32), hexes(40), hexes(64), word() * 2 + word()]),
            5: lambda: f"{pick(['000', '666', '9' + num(2)])}-{num(2)}-{num(4)}", 6: lambda: pick([f"AB{num(2)} {num(4)} {num(4)}", f"XK{num(18)}"]),
            7: lambda: pick([clock(), clock(), f"{rng.integers(1, 99)}:{num(2)}:{num(2)}:{num(2)}", f"{pick('abcdef')}::{pick('abcdef')}", "::"]),
            8: lambda: pick([":", "-"]).join(num(2) for _ in range(6)),
            9: lambda: f"{rng.integers(1, 40)} {proper()} {pick(['Court', 'Place', 'Way', 'Square', 'Drive', 'Terrace'])}", 10: person, 11: date,
            12: lambda: pick([f"{pick('ABCDEFGHKLMNPX')}{num(int(rng.integers(6, 9)))}", f"{pick('ABCDEFGHKLMNPX')}{pick('ABCDEFGHKLMNPX')}{num(6)}"])}
    signs = {0: ["mail me: ", "contact ", "write to ", "reach me: "], 3: ["call ", "phone: ", "tel. ", "mobile ", "dial ", "fax "],
             4: ['token = "', "api_key: ", 'secret = "', "password: ", "auth="], 5: ["SSN ", "SSN: ", "social security number "],
             6: ["IBAN ", "account ", "bank transfer to "],
             7: ["from ", "ip ", "address ", "host ", "inet6 "], 8: ["MAC ", "ether ", "device ", "hardware address "],
             9: ["address: ", "lives at ", "ship to ", "home address ", "residing at "],
             10: ["my name is ", "name: ", "full name: ", "patient ", "customer: ", "employee ", "signed by "],
             11: ["born ", "born on ", "date of birth: ", "DOB: ", "DOB "], 12: ["passport ", "passport no. ", "passport number: "]}

    def run(n, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"):
        return "".join(letters[i] for i in rng.integers(0, len(letters), n))

    def length():
        return int(2 ** rng.uniform(7, 12.5))

    # keys and tokens of any length
    long = {4: lambda: pick([hexes(length()), run(length()), f"eyJ{run(33)}.eyJ{run(length())}.{run(43)}"])}
    # keys of a known make, key blocks and passwords in links, whatever stands before them
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    made = {4: lambda: pick([f"AKIA{run(16, capitals)}", f"xoxb-{num(12)}-{run(24, capitals)}", f"ghp_{run(36, capitals.lower() + capitals)}",
                             f"sk-{run(32, capitals + capitals.lower())}", f"AIza{run(35)}", f"eyJ{run(33)}.eyJ{run(length())}.{run(43)}",
                             f"-----BEGIN {pick(['RSA ', 'EC ', ''])}PRIVATE KEY-----\n{run(length())}\n-----END PRIVATE KEY-----"])}
    # what somebody says a password is, against what is said of one
    said = {4: lambda: pick([word() + num(3), word().title() + num(2) + "!", run(12), word() + pick("!#$_") + word() + num(1)])}
    speech = {4: lambda: word() + word()[:4] + pick(["", "", ",", "."])}
    linked = {4: lambda: pick([word() + num(3), run(12), word().title() + num(2) + "!"])}
    # only one of @ and dot written out
    mixed = {0: lambda: f"{name()} {pick(['(at)', '[at]', '(@)', 'at'])} {pick(['', '', 'mail.'])}{word()}.{pick(['com', 'org', 'net', 'de'])}"}
    prose = {0: lambda: f"{word()} at {word()}.{pick(['com', 'org', 'js', 'py'])}"}
    forms = [*((kind, real, fake, each) for kind in FOR), (4, long, long, each // 2), (0, mixed, prose, each), (4, made, fake, each),
             (4, linked, fake, each // 2), (4, said, speech, each)]
    rows, truth, kinds = [], [], []
    for kind, real, fake, many in forms:
        for i in range(2 * many):
            good = i < many
            span = (real if good else fake)[kind]()
            plain = [" ".join(word() for _ in range(3)) + " ", *(f"{a} " for a in AGAINST)]
            strong = {0: 0.5, 3: 0.7, 4: 0.97, 5: 0.8, 6: 0.6, 7: 0.5, 8: 0.5, 9: 0.5}.get(kind, 0.9)
            strong = 0.3 if real is made else strong
            neutral = good and kind in (3, 5, 9) and rng.random() < 0.5
            lead = pick(signs[kind]) if good and rng.random() < strong else plain[0] if neutral else pick(plain)
            if not good and kind == 4 and "=" in lead:
                lead = "commit "
            tail = pick([' ', '.', ', ', chr(34) + ' '])
            if real is said:
                lead = pick(["password is ", "the secret is ", "passcode is ", "pin was ", "the key is ", "token is "])
            if real is linked and good:
                lead, tail = f"{pick(['postgres', 'https', 'mysql', 'ftp'])}://{word()}:", "@"
            text = f"{' '.join(word() for _ in range(4))} {lead}{span}{tail}{word()}"
            start = text.index(lead) + len(lead)
            rows.append(describe(text, start, kind, start + len(span)))
            # "word at word.com" is an address only where the text speaks of one
            unsure = kind in (3, 4) or (kind == 0 and "dot" not in span and " at " in span and "." not in span.split(" at ")[0])
            # a number written as a phone number is one unless the text calls it something else, and so are streets and SSNs
            formed = kind == 3 and (span[0] == "(" or re.fullmatch(r"\d{3}-\d{3}-\d{4}", span)) and lead == plain[0]
            named = kind in (10, 11, 12) or (kind in (5, 9) and lead != plain[0])
            truth.append(bool(good and (real is made or formed or not ((unsure or named) and lead in plain))))
            kinds.append(kind)
    return np.array(rows, float), np.array(truth), np.array(kinds)


Node = tuple  # (feature, threshold, at or below, above) or a value


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree on gradients and second derivatives."""
    def gain(mask):
        return g[mask].sum() ** 2 / (h[mask].sum() + 1)

    best = (1e-3, None, 0.0)
    if depth:
        whole = gain(np.ones(len(g), bool))
        for feature in range(x.shape[1]):
            levels = np.unique(x[:, feature])
            levels = levels if len(levels) < 17 else np.unique(np.quantile(levels, np.linspace(0, 1, 17)))
            for threshold in (levels[1:] + levels[:-1]) / 2:
                low = x[:, feature] <= threshold
                better = gain(low) + gain(~low) - whole
                if better > best[0] + 1e-9:
                    best = (better, feature, float(threshold))
    _, feature, threshold = best
    if feature is None:
        return float(g.sum() / (h.sum() + 1))
    low = x[:, feature] <= threshold
    return feature, threshold, _tree(x[low], g[low], h[low], depth - 1), _tree(x[~low], g[~low], h[~low], depth - 1)


def _value(tree, row) -> float:
    while not isinstance(tree, float):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@dataclass(frozen=True)
class Judge:
    trees: list
    rate: float
    slope: float
    shift: float
    least: dict

    def margin(self, row) -> float:
        return self.rate * sum(_value(t, row) for t in self.trees)

    def probability(self, row) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.margin(row) + self.shift))))


def train(rounds: int = 40, depth: int = 3, rate: float = 0.3) -> Judge:
    """Boost on two thirds of the examples; calibrate and choose thresholds on the rest."""
    x, y, kinds = examples()
    fold = np.random.default_rng(1).random(len(x)) < 2 / 3
    trees, f = [], np.zeros(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        trees.append(_tree(x[fold], (y - p)[fold], (p * (1 - p))[fold], depth))
        f += rate * np.array([_value(trees[-1], r) for r in x])
    slope, shift, held = 1.0, 0.0, f[~fold]
    truth = y[~fold].astype(float)
    for _ in range(200):  # Platt scaling; the prior keeps it finite where the classes separate
        p = 1 / (1 + np.exp(-np.clip(slope * held + shift, -30, 30)))
        slope += 0.5 * (((truth - p) * held).mean() - 0.02 * slope)
        shift += 0.5 * (truth - p).mean()
    p = 1 / (1 + np.exp(-np.clip(slope * held + shift, -30, 30)))
    least = {}
    for kind in FOR:
        own = kinds[~fold] == kind
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(truth[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        ranked = [*p[own][order], 0.0]  # half way to the next one below
        least[kind] = max(0.5, float(ranked[good[-1]] + ranked[good[-1] + 1]) / 2) if len(good) else 1.1
    return Judge(trees, rate, slope, shift, least)


def spans(text: str, judge: Judge) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: added ones overlap neither the base nor a likelier one.

    A secret may hold base spans, such as a card number within a long key, that make up less than half of it.
    """
    base = base_spans(text)
    taken, out = [], list(base)
    judged = []

    def beside_base(start: int, kind: int, end: int) -> bool:
        hit = [(a, b) for a, _, b in base if a < end and start < b]
        return not hit or (kind == 4 and all(start <= a and b <= end for a, b in hit)
                           and 2 * sum(b - a for a, b in hit) < end - start)

    for start, kind, end in candidates(text):
        p = judge.probability(describe(text, start, kind, end))
        if p >= judge.least[kind]:
            judged.append((-p, start, kind, end))
    for _, start, kind, end in sorted(judged):
        if beside_base(start, kind, end) and all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            out.append((start, kind, end))
    return base, sorted(out)


def written(found: list[tuple[int, int, int]]) -> str:
    """``kind:start:end`` by start, then kind, comma-joined."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base (written base spans), spans (all written spans) and redacted for each row of ``docs`` (doc_id, text).

    Offsets are code points, end exclusive, over the whole text. Null texts count as empty and have no spans; their redacted
    text is empty. Repeated rows get equal results; other columns are left out. ``redacted`` has ``[KIND]`` for every span.
    """
    judge = train()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base, every = spans(text, judge)
            clean, last = [], 0
            for a, k, b in every:
                if a >= last:
                    clean += [text[last:a], f"[{KINDS[k].upper()}]"]
                last = max(last, b)
            rows.append((written(base), written(every), "".join([*clean, text[last:]])))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.string()) for c in zip(*rows, strict=True))],
                                          ["doc_id", "base", "spans", "redacted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), "text", f"doc_id {kind}, base string, spans string, redacted string", work)
