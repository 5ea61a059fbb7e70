"""Personal information inside free text: found, and replaced by typed placeholders.

Method: anchor expansion. One Aho-Corasick pass over the text in its consistent character form finds
anchors: at-signs and their spoken forms, schemes, digits, words that introduce addresses and documents, parts of
personal names and words that introduce names. An e-mail address is expanded from its at-sign in both directions
as far as its characters go, a Chinese name from its given name; the other things are read by deterministic
parsers that a text without their anchors is spared. Each parser validates what it found (digits of a number, date
inside an identity number, house number, both parts of a name). No parser has a reach beyond which a thing would be
cut. Found spans are mapped back to the text as stored, so all else is kept.

Defined results: null stays null and holds nothing; empty and blank texts hold nothing; overlapping finds
keep the kind that comes first in KINDS; texts of any length are read whole; a user's part of a web address is none.
"""

from __future__ import annotations

import datetime
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.charforms import _BLANK, _IGNORED, _OTHER, _TOKEN, Lattice

KINDS = ("email", "id_number", "phone", "address", "name")

# --- parsers -------------------------------------------------------------------------------------------------
# what stands before and behind an at-sign, written or spoken
_DOT = r"(?:\.|\ ?\[dot\]\ ?|\ ?\(dot\)\ ?)"
_WRITTEN = regex.compile(rf"\ ?[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9-])", regex.I)
_SPOKEN = regex.compile(r"[A-Za-z0-9-]+(?:(?:\ (?:dot|punto|点)\ |\.)[A-Za-z0-9-]+)*\ (?:dot|punto|点)\ [A-Za-z]{2,}(?![A-Za-z0-9-])", regex.I)
_LOCAL_SET = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._+-")
_URL_SET = _LOCAL_SET | frozenset(":/%@~")
AT_WRITTEN, AT_SPOKEN = ("@", "[at]", "(at)", "{at}"), (" at ", " arroba ", " 艾特 ")


def email_at(text: str, start: int, end: int, spoken: bool) -> tuple[int, int] | None:
    """The e-mail address around an at-sign that stands at [start, end)."""
    s = start - (not spoken and start > 0 and text[start - 1] == " ")
    first = s
    while first and text[first - 1] in _LOCAL_SET:
        first -= 1
    while first < s and not text[first].isalnum():
        first += 1
    m = first < s and (_SPOKEN if spoken else _WRITTEN).match(text, end)
    if not m:
        return None
    before = first
    while before and not text[before - 1].isspace() and text[before - 1] in _URL_SET:
        before -= 1
    return None if "://" in text[before:first] else (first, m.end())


ID18 = regex.compile(r"(?<![\dA-Za-z])\d{6}[ -]?(\d{4})(\d{2})(\d{2})[ -]?\d{3}[\dXx](?![\dA-Za-z])")
SOCIAL = regex.compile(r"(?<![\d-])\d{3}([- ])\d{2}\1\d{4}(?![\d-])")
PASSPORT = regex.compile(r"(?:passport|pasaporte|护照|通行证|documento|dni|nie)[^\dA-Za-z]{0,3}(?:(?:no|nr|number|num|número|núm|号码?|nº)[.: °ºo]{0,3})?[^\dA-Za-z]{0,3}([A-Z]{1,2}\d{6,9}|\d{8}[A-Z]?)(?![\dA-Za-z])", regex.I)
CN_MOBILE = regex.compile(r"(?<![\d-])(?:(?:\+|00)?86[- ]?)?1[3-9]\d[- ]?\d{4}[- ]?\d{4}(?![\d-]|[.]\d)")
NANP = regex.compile(r"(?<![\d.-])(?:\+?1[-. ]?)?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?![\d-]|[.]\d)")
ABROAD = regex.compile(r"(?<![\d+])(?<!\d )(?:\+|00)[1-9]\d{0,2}[ .-]?(?:\(0\) ?)?\d{1,5}(?:[ .-]?\d{2,8}){1,5}(?![\d-]|\ \d)")
UK = regex.compile(r"(?<![\d+-])0(?:7\d{3} ?\d{6}|7\d{3} ?\d{3} ?\d{3}|[12]\d{1,3} \d{3,4} \d{3,4})(?![\d-])")
ES = regex.compile(r"(?<![\d+-])[679]\d{2} \d{2} \d{2} \d{2}(?![ ]?\d)")
_PLACE = r"[^\P{Han}寄到在住搬送往去址是了从至于给来]"  # letters of a place, not those of a verb before it
HAN_ADDRESS = regex.compile(rf"(?:{_PLACE}{{2,4}}[省市县]){{0,2}}(?:{_PLACE}{{2,4}}[区镇乡])?{_PLACE}{{1,4}}(?:大道|胡同|[路街巷道弄])\ ?\d+\ ?号(?:楼)?(?:\ ?\d+\ ?(?:栋|幢|座|号楼|单元|室|楼|层)){{0,3}}(?:\d+室?)?")
_CAP = r"(?:\p{Lu}[\p{L}'’]*)"
_STREET = r"(?:Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Row|Quay|Terrace|Drive|Dr|Way|Court|Ct|Close|Square|Sq|Place|Pl|Boulevard|Blvd|Crescent|Alley|Hill|Gardens|Mews|Parade|STREET|ST|ROAD|RD|AVENUE|AVE|LANE|ROW|QUAY|TERRACE|DRIVE|WAY|COURT|CLOSE|SQUARE|PLACE)"
EN_ADDRESS = regex.compile(rf"(?:(?i:Flat|Apt|Apartment|Unit|Suite)\.?\ ?\#?\w+,\ )?(?<![\d:.,/-])\d{{1,5}}[A-Za-z]?\ (?:{_CAP}\ ){{1,3}}{_STREET}\b\.?(?:,\ {_CAP}(?:\ {_CAP})?(?:\ \d{{4,6}})?)?")
ES_ADDRESS = regex.compile(
    rf"(?<![\p{{L}}])(?:(?i:Calle|Avenida|Avda\.?|Plaza|Paseo|Camino|Carrera|Ronda)\ |C/\ ?|Av\.\ )(?:(?i:de\ la|de\ los|de\ las|del|de|la|el)\ )?{_CAP}(?:\ {_CAP})?,?\ (?:(?i:n[ºo°]\.?)\ ?)?\d{{1,4}}(?!\d)(?:,\ \d{{1,2}}[ºo°ª]\ ?[A-Za-z]?\b)?"
)

# --- names ---------------------------------------------------------------------------------------------------
# fixed values: parts of names that are ordinary words as well, so that they alone prove nothing
ORDINARY = frozenset("rose may hope grant summer field lane garden grace joy will mark bill frank iris lily june april autumn dawn brook wood hill stone king young green brown white black day rain snow".split())
# fixed values: common Chinese family names that aren't everyday function words, then those of two characters
FAMILIES = frozenset(
    "李王张刘陈杨赵黄周吴徐孙胡朱林郭马罗梁宋郑谢韩唐冯董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎"
    "武乔贺赖龚樊兰殷施陶洪翟倪严牛温芦季俞章鲁葛伍韦申尤毕聂丛焦柳邢岳梅庄辛管祝左涂谷祁耿牟卜路詹欧靳裴甘喻应高宁臧瞿缪闻褚荀晏郗方柯桂宫邬冉蒙阮项虞舒卞华齐"
)
FAMILIES2 = frozenset("欧阳 司马 上官 诸葛 令狐 濮阳 夏侯 皇甫 尉迟 公孙 慕容 宇文 长孙 司徒 独孤 南宫 东方 端木 闻人 司空".split())
_T = r"(?:\p{Lu}[\p{Ll}'’]+|\p{Lu}{2,})"
LATIN_NAME = regex.compile(rf"(?<![\p{{L}}\p{{N}}@._+-])(?:(?P<g1>{_T})(?:\ \p{{Lu}}\.)?\ (?P<f1>{_T}(?:-{_T})?)|(?P<f2>{_T}(?:-{_T})?),\ (?P<g2>{_T}))(?![\p{{L}}\p{{N}}@_]|[.+-][\p{{L}}\p{{N}}])")
LOWER_NAME = regex.compile(r"(?<![\p{L}\p{N}@._+-])(?P<g1>\p{Ll}{2,}) (?:\p{Ll}\. )?(?P<f1>\p{Ll}{2,}(?:-\p{Ll}{2,})?)(?![\p{L}\p{N}@_-])")
# fixed values: words that announce a name, and words behind one
BEFORE = ("ran into", "ask for", "asked for", "ship it to", "send it to", "sent to", "this is", "my name is", "name is", "i am", "i'm", "here:", "name:", "soy", "me llamo", "vi a", "conocí a", "a nombre de",
          "signed by", "call", "meet", "dear", "mr", "mr.", "mrs", "mrs.", "ms", "ms.", "sr", "sr.", "sra", "sra.", "don", "doña")
BEHIND = ("signed for", "signed", ", mail me", "mail me", ", mi correo", "mi correo", "at the desk", "called", "has moved", "lives at", "vive en", "/ ")
CUE_BEFORE = regex.compile(r"(?:\b(?:" + "|".join(map(regex.escape, sorted(BEFORE, key=len, reverse=True))) + r"))\s*$", regex.I)
CUE_AFTER = regex.compile(r"^\s*(?:" + "|".join(map(regex.escape, BEHIND)) + ")", regex.I)
# fixed values: the same in Chinese
HAN_BEFORE = ("联系", "收件人", "寄件人", "找", "我叫", "叫做", "名叫", "碰到", "遇到", "见到", "请附", "附上", "署名", "姓名", "本人", "我是", "转交", "交给")
HAN_BEHIND = ("刚打电话", "打电话来", "来电", "签收")
HAN_CUE = regex.compile(
    rf"(?:{'|'.join(HAN_BEFORE)})[:： ]?(?P<n>\p{{Han}}{{2,4}}?)(?=就行|签字|了|[,，:：。 ]|和|以后|收|$|\d)"
    rf"|(?:^|[,，。!！ :：])(?P<n2>\p{{Han}}{{2,4}}?)(?={'|'.join(HAN_BEHIND)})"
)


def _date(y: str, m: str, d: str) -> bool:
    try:
        return 1900 <= int(y) <= 2035 and bool(datetime.date(int(y), int(m), int(d)))
    except ValueError:
        return False


def _character(ch: str) -> tuple[str, bool]:
    """A character's consistent form, empty if ignorable, and whether it may join the one before it."""
    if _IGNORED.match(ch):
        return "", False
    form = "".join(" " if _BLANK.match(c) else c for c in unicodedata.normalize("NFKC", ch))
    return form, any(unicodedata.combining(c) for c in form)


_FORMS: dict[str, tuple[str, bool]] = {}  # by character, so bounded by Unicode


class Finder:
    """``parts``: (part, kind given or family, script latin or han), which may be incomplete."""

    def __init__(self, parts: Iterable[tuple[str, str, str]], lattice: Lattice | None = None):
        self.lattice = lattice or Lattice()
        low = [(p.lower(), k, s) for p, k, s in parts if p]
        self.given = {p for p, k, s in low if k == "given"}
        self.family = {p for p, k, s in low if k == "family"}
        self.han_given = {p for p in self.given if regex.match(r"\p{Han}", p)}
        self.han_family = {p for p in self.family if regex.match(r"\p{Han}", p)} | FAMILIES | FAMILIES2
        self.anchors = ahocorasick.Automaton()
        words = {
            "written": AT_WRITTEN, "spoken": AT_SPOKEN,
            "number": tuple("0123456789"),
            "name": [p for p in self.given | self.family if not regex.match(r"\p{Han}", p)],
            "cue": BEFORE + BEHIND,
            "han": sorted(self.han_given),
            "hancue": HAN_BEFORE + HAN_BEHIND,
        }
        for kind, ws in words.items():
            for w in ws:
                found = self.anchors.get(w, (len(w), frozenset()))
                self.anchors.add_word(w, (len(w), found[1] | {kind}))
        self.anchors.make_automaton()
        self.kept: dict[tuple[str, bool], list[tuple[int, int, str]]] = {}

    # the text in its consistent form, with the place in the stored text of each character
    def _form(self, text: str) -> tuple[str, list[int] | None]:
        if text.isascii() and text.isprintable():
            return text, None
        out: list[str] = []
        at: list[int] = []
        for i, ch in enumerate(text):
            made = _FORMS.get(ch)
            if made is None:
                made = _FORMS[ch] = _character(ch)
            for c in made[0]:
                if made[1] and out and unicodedata.combining(c) and len(joined := unicodedata.normalize("NFC", out[-1] + c)) == 1:
                    out[-1] = joined
                    continue
                out.append(c)
                at.append(i)
        form = "".join(out)
        if _OTHER.search(form):
            form = _TOKEN.sub(lambda m: self.lattice.resolve(m[0]), form)
        return form, at

    def spans(self, text: str, is_name_field: bool = False) -> list[tuple[int, int, str]]:
        """(start, end, kind) in the stored text, in order, without overlaps."""
        if (known := self.kept.get((text, is_name_field))) is not None:
            return known
        form, at = self._form(text)
        low = form.lower()
        if len(low) != len(form):  # a letter whose lower case is longer
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in form)
        hits: dict[str, list[tuple[int, int]]] = {}
        for end, (size, kinds) in self.anchors.iter(low):
            for k in kinds:
                hits.setdefault(k, []).append((end + 1 - size, end + 1))
        found = [(*m, "email") for k in ("written", "spoken") for a, b in hits.get(k, ()) if (m := email_at(form, a, b, k == "spoken"))]
        if "number" in hits:
            found += self._numbers(form)
        if is_name_field or "name" in hits or "cue" in hits:
            found += self._latin(form, is_name_field)
        if is_name_field or "han" in hits or "hancue" in hits:
            found += self._han(form, hits.get("han", ()), is_name_field)
        order = {k: i for i, k in enumerate(KINDS)}
        kept: list[tuple[int, int, str]] = []
        for x in sorted(set(found), key=lambda x: (order[x[2]], x[0], -x[1])):
            i = bisect_left(kept, x)
            if (not i or kept[i - 1][1] <= x[0]) and (i == len(kept) or x[1] <= kept[i][0]):
                kept.insert(i, x)
        if at is not None:
            kept = [(at[s], at[e - 1] + 1, k) for s, e, k in kept]
        if len(self.kept) < 100_000 and len(text) < 200:
            self.kept[text, is_name_field] = kept
        return kept

    @staticmethod
    def _numbers(t: str) -> list[tuple[int, int, str]]:
        out = [(m.start(), m.end(), "id_number") for m in ID18.finditer(t) if _date(m[1], m[2], m[3])]
        out += [(m.start(), m.end(), "id_number") for m in SOCIAL.finditer(t)]
        out += [(m.start(1), m.end(1), "id_number") for m in PASSPORT.finditer(t)]
        for p in (CN_MOBILE, NANP, UK, ES):
            out += [(m.start(), m.end(), "phone") for m in p.finditer(t)]
        out += [(m.start(), m.end(), "phone") for m in ABROAD.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
        for p in (HAN_ADDRESS, EN_ADDRESS, ES_ADDRESS):
            out += [(m.start(), m.end(), "address") for m in p.finditer(t)]
        return out

    def _latin(self, t: str, alone: bool) -> list[tuple[int, int, str]]:
        out = []
        pos, shouted = 0, 5 * sum(map(str.islower, t)) < sum(map(str.isupper, t))
        while m := LATIN_NAME.search(t, pos):
            g, f = (m["g1"] or m["g2"]).lower(), (m["f1"] or m["f2"]).lower()
            listed_g, listed_f = g in self.given, any(x in self.family for x in f.split("-"))
            plain = all(x in ORDINARY for x in (g, *f.split("-")))
            before, after = t[max(0, m.start() - 24) : m.start()], t[m.end() : m.end() + 16]
            cue = bool(CUE_BEFORE.search(before) or CUE_AFTER.search(after))
            if alone:
                cue = not before.strip() and (not after.strip() or after.lstrip().startswith("(")) or cue
            shout = not alone and shouted and m[0].isupper()
            in_address = bool(regex.search(r"\d[A-Za-z]?\ $", before)) or bool(regex.match(rf"\ {_STREET}\b", after))
            if listed_g and listed_f:
                ok = not (plain and (shout or (in_address and not cue)))
            elif listed_g or listed_f:
                one = g if listed_g else f
                ok = not in_address and (cue or (one not in ORDINARY and not shout and not (listed_f and m.start() == 0 and m["f2"])))
            else:
                ok = cue and not in_address and not shout
            if ok:
                out.append((m.start(), m.end(), "name"))
                pos = m.end()
            else:  # another pair may begin with the second word
                pos = m.start() + len(m["g1"] or m["f2"])
        for m in LOWER_NAME.finditer(t, overlapped=True):
            fs = m["f1"].split("-")
            if m["g1"] in self.given and any(x in self.family for x in fs) and not (m["g1"] in ORDINARY and all(x in ORDINARY for x in fs)):
                out.append((m.start(), m.end(), "name"))
        return out

    def _han(self, t: str, given: Sequence[tuple[int, int]], alone: bool) -> list[tuple[int, int, str]]:
        out = []
        for i, end in given:
            if end - i > 1:  # one character is no given name by itself
                fam = next((n for n in (2, 1) if i >= n and t[i - n : i] in self.han_family and (not alone or not t[: i - n].strip())), 0)
                if fam:
                    out.append((i - fam, end, "name"))
        if alone and (m := regex.match(r"\s*(\p{Han}{2,4})(?= ?[(（])", t)) and self._is_han(m[1]):
            out.append((m.start(1), m.end(1), "name"))
        for m in HAN_CUE.finditer(t):
            for name in ("n", "n2"):
                if m[name] and self._is_han(m[name]):
                    out.append((m.start(name), m.end(name), "name"))
        return out

    def _is_han(self, n: str) -> bool:
        return (n[:2] in self.han_family and 3 <= len(n) <= 4) or (n[:1] in self.han_family and 2 <= len(n) <= 3)

    def cued(self, text: str) -> list[tuple[str, str, str]]:
        """(given, family, script) of names that stand where a name is announced, both parts listed or not."""
        form, _ = self._form(text)
        low = form.lower()
        announced = {k for _, (_, kinds) in self.anchors.iter(low) for k in kinds} & {"hancue", "cue"}
        out = []
        for m in HAN_CUE.finditer(form) if "hancue" in announced else ():
            n = m["n"] or m["n2"]
            if self._is_han(n):
                cut = 2 if n[:2] in self.han_family else 1
                out.append((n[cut:], n[:cut], "han"))
        for m in LATIN_NAME.finditer(form) if "cue" in announced else ():
            if CUE_BEFORE.search(form[max(0, m.start() - 24) : m.start()]) and (m[0] != m[0].upper()):
                out.append(((m["g1"] or m["g2"]).lower(), (m["f1"] or m["f2"]).lower().split("-")[0], "latin"))
        return out

    def replaced(self, text: str, is_name_field: bool = False) -> str:
        out, end = [], 0
        for s, e, k in self.spans(text, is_name_field):
            out += [text[end:s], f"[{k.upper()}]"]
            end = e
        return "".join(out) + text[end:] if out else text


def learned_parts(df: DataFrame, column: str, finder: Finder, least: int = 3) -> DataFrame:
    """(part, kind, script): parts of names missing from the list. A part is learned if, where names are
    announced, it stands with at least ``least`` different listed parts of the other kind, counted over the
    whole collection. The result is a vocabulary; it doesn't grow with the number of texts."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[str, str, str, str]] = set()
        for b in batches:
            for text in set(b[column]):
                for g, f, script in finder.cued(text):
                    if f in finder.family and g not in finder.given:
                        seen.add((g, "given", script, f))
                    elif g in finder.given and f not in finder.family:
                        seen.add((f, "family", script, g))
        yield pd.DataFrame(sorted(seen), columns=["part", "kind", "script", "other"])

    found = df.select(column).where(F.col(column).isNotNull()).mapInPandas(pairs, "part string, kind string, script string, other string")
    return found.groupBy("part", "kind", "script").agg(F.count_distinct("other").alias("n")).where(F.col("n") >= least).drop("n")


def kinds_of(column: Column, finder: Finder, is_name_field: bool = False) -> Column:
    """array<string>: the kinds a text holds."""

    @F.pandas_udf("array<string>")
    def kinds(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else sorted({k for _, _, k in finder.spans(t, is_name_field)}))

    return kinds(column)


def redacted(column: Column, finder: Finder, is_name_field: bool = False) -> Column:
    """The text with a typed placeholder in place of each find."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else finder.replaced(t, is_name_field))

    return clean(column)
