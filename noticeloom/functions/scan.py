"""Reading notices line by line: the parts of extraction whose rules speak of lines and of what follows a label.

Plain functions of texts; ``operators.extract`` runs them over columns. A notice is cut into lines once and asked many questions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cache, cached_property
from typing import NamedTuple

from noticeloom.functions import patterns as P

# Labels at which a value ends, in portal notices.
PORTAL_LABELS = ["项目规模", "建设规模", "工程规模", "招标编号", "项目编号", "招标内容与范围", "招标范围", "招标内容", "获取时间", "获取方法", "获取方式", "发售时间", "文件售价", "标书售价", "递交截止时间", "递交方法", "递交方式", "递交地址", "开标时间", "开标方式", "开标地址", "开启时间", "开启方式", "开启地点", "投标保证金", "保证金", "联系人", "联 系 人", "电话", "电 话", "联系方式", "地址", "详细地址", "邮箱", "电子邮件", "开户行名称", "开户银行", "账号", "招标人", "招标代理机构", "监督部门", "行政监督部门", "中标人", "中标人名称", "中标价格", "中标价", "中标金额", "公示开始时间", "公示结束时间", "发布日期", "浏览次数", "一、评标情况", "一、中标人信息"]
# Words at which a value ends, in document notices.
DOCUMENT_STOPS = ["招标编号", "项目编号", "招标项目所在地区", "招标条件", "项目概况", "投标人资格", "招标文件的获取", "投标文件的递交", "开标时间", "监督部门", "联系方式", "中标人", "中标价格", "公示时间", "公示开始", "公示结束"]
_HAN = "一二三四五六七八九十"
_NUMBERED = re.compile(rf"\s*(?:\d+(?:\.\d+)*[、.．]|[{_HAN}]+[、.．])")
_PORTAL_LABEL = re.compile(r"\s*(?:\d+(?:\.\d+)*\s*)?(?:" + "|".join(map(re.escape, sorted(PORTAL_LABELS, key=len, reverse=True))) + r")\s*[：:]")
_DOCUMENT_STOP = re.compile("|".join(map(re.escape, DOCUMENT_STOPS)) + rf"|[{_HAN}][、.．]")
_CHAPTER = re.compile(r"公示开始时间|公示结束时间|发布日期|浏览次数|(?:十[一二]|[一二三四五六七八九十])[、.．]")
_BLOCK_TAG = re.compile(r"(?i)<\s*br\s*/?\s*>|<\s*/?\s*(?:p|div|li|tr|h[1-6])\b[^>]*>")


def one_line(s: str) -> str:
    return " ".join(s.split())


class Lines(list):
    """Lines of a text; what is asked of the whole of them is put together once."""

    @cached_property
    def whole(self) -> str:
        return "\n".join(self)


_TAG, _BLANK, _GAP = re.compile(r"<[^>]+>"), re.compile(r"&[ne][bmn]sp;|\xa0"), re.compile(r"[ \t]+")


def to_lines(s: str | None) -> Lines:
    """HTML or text as its non-empty lines. Most texts have no tags, entities or gaps, and are not searched for them."""
    t = html.unescape(s or "")
    if "<" in t:
        t = _TAG.sub("", _BLOCK_TAG.sub("\n", t))
    if "&" in t or "\xa0" in t:
        t = _BLANK.sub(" ", t)
    gaps = "  " in t or "\t" in t
    return Lines(x for x in ((_GAP.sub(" ", line) if gaps else line).strip() for line in t.splitlines()) if x)


def portal_end(line: str) -> bool:
    """A numbered section or a label begins."""
    return bool(_NUMBERED.match(line) or _PORTAL_LABEL.match(line))


def document_end(line: str) -> bool:
    return bool(_NUMBERED.match(line) or _DOCUMENT_STOP.search(line))


@dataclass(frozen=True)
class Dialect:
    """How one source writes: where a value ends, and whether a label must begin a word."""

    ends: Callable[[str], bool]
    label: str

    def behind(self, label: str, line: str) -> str | None:
        m = _behind(self.label, label).search(line) if label in line else None
        return m[1].strip() if m else None


@cache
def _behind(form: str, label: str) -> re.Pattern:
    return re.compile(form.format(re.escape(label)))


def _said(lines: list[str], words: list[str]) -> list[str]:
    """Those of ``words`` that stand in a line at all: most questions to a notice are about labels that it does not have."""
    whole = lines.whole if isinstance(lines, Lines) else "\n".join(lines)
    return [w for w in words if w in whole]


PORTAL = Dialect(portal_end, r"(?:^|\s)(?:\d+(?:\.\d+)*\s*)?{}\s*[：:]\s*(.*)$")
DOCUMENT = Dialect(document_end, r"{}\s*[：:]\s*(.*)$")


def tail(first: str, rest: Iterable[str], ends: Callable[[str], bool]) -> str:
    """A value and the lines that continue it."""
    out = [first] if first else []
    for line in rest:
        if ends(line):
            break
        out.append(line)
    return one_line(" ".join(out))


def labelled(lines: list[str], labels: list[str], dialect: Dialect = PORTAL) -> str:
    """The value behind a label: the first line with a label and a value; labels in their order within a line."""
    labels = _said(lines, labels)
    if not labels:
        return ""
    for i, line in enumerate(lines):
        for label in labels:
            first = dialect.behind(label, line)
            if first is not None and (got := tail(first, lines[i + 1 :], dialect.ends)):
                return got
    return ""


def block(lines: list[str], starts: list[str], stops: list[str], hard: re.Pattern | None = None) -> Lines:
    """From the first line with one of ``starts`` to before the next with one of ``stops``."""
    starts = _said(lines, starts)
    if not starts:
        return Lines()
    begin = next(i for i, x in enumerate(lines) for s in starts if s in x)
    stops = _said(lines, stops)
    end = len(lines)
    if stops or hard:
        end = next((i for i in range(begin + 1, end) if (hard and hard.match(lines[i])) or any(s in lines[i] for s in stops)), end)
    return Lines(lines[begin:end])


def section(lines: list[str], starts: list[str], stops: list[str]) -> str:
    """A section on one line, without its heading; a heading's own value stays."""
    got = block(lines, starts, stops)
    if not got:
        return ""
    start = next(s for s in starts if s in got[0])
    own = re.search(re.escape(start) + r"\s*[：:]\s*(.*)$", got[0])
    return one_line(" ".join([own[1] if own else "", *got[1:]]))


def before(lines: list[str], stops: list[str], noise: tuple[str, ...] = ("发布日期", "浏览次数", "我要申请")) -> str:
    """The lines before a section, without a page head's noise."""
    out = []
    for line in lines:
        if any(s in line for s in stops):
            break
        if not any(n in line for n in noise):
            out.append(line)
    return one_line(" ".join(out))


_PHONE, _NOTE, _NUMBERS = re.compile(P.PHONE), re.compile(P.PHONE_NOTE), re.compile(P.PHONE_NUMBERS)
_BEFORE_STOP = re.compile(rf"(?s).+?(?={'|'.join(P.PHONE_STOPS)}|\Z)")


def phone_only(s: str) -> str:
    """The telephone numbers at the start of a value, up to what belongs to another field."""
    own = _BEFORE_STOP.match(one_line(s))
    text = own[0].strip() if own else ""
    return (_PHONE.match(text)[0].strip() or text).strip(" ：:，,；;")


def continues_phone(line: str) -> bool:
    """Whether a line holds nothing but more numbers, such as ``0351-2221744（财务）``: three digits in a row at least, 35 characters at most."""
    own = "".join(line.split())
    bare = _NOTE.sub("", own)
    return len(own) <= 35 and bool(_NUMBERS.fullmatch(bare)) and re.search(r"\d{3}", bare) is not None


# How the parties of a contact section and their fields are labelled.
PARTIES = {"bidder": (["招标人", "采购人"], ["招标代理机构", "代理机构"]), "agent": (["招标代理机构", "代理机构"], ["邮箱", "电子邮件", "开户行名称", "开户银行", "账号", "账户"])}
CONTACT_LABELS = {"address": ["招标代理机构地址", "招标人地址", "详细地址", "地址", "地 址"], "contact": ["招标代理机构联系人", "招标人联系人", "联系人", "联 系 人"], "phone": ["招标代理机构联系方式", "招标人联系方式", "联系方式", "电话", "电 话"]}


def contact(lines: list[str], party: str, field: str) -> str:
    """A party's name, address, contact or phone, from its block of the contact section."""
    begin = next((i + 1 for i, x in enumerate(lines) if "联系方式" in x), 0)
    own = block(lines[begin:], *PARTIES[party], _CHAPTER)
    labels = _said(own, PARTIES[party][0] if field == "name" else CONTACT_LABELS[field])
    for i, line in enumerate(own) if labels else ():
        for label in labels:
            m = _behind(DOCUMENT.label, label).search(line)
            if m and field != "phone":
                return m[1].strip()
            if m:
                return phone_only(tail(m[1].strip(), own[i + 1 :], lambda x: bool(_PORTAL_LABEL.match(x) or _CHAPTER.match(x)) or not continues_phone(x)))
    return ""


class Event(NamedTuple):
    """A line as a grammar reads it: its role ("" for plain text), the label as written, the value behind it."""

    role: str
    said: str
    value: str
    line: str


#: Each rule's role, the words of which a line must have one, how its pattern is looked for, and its groups for label and value (0: none).
Grammar = list[tuple[str, tuple[str, ...], Callable[[str], re.Match | None], int, int]]


def grammar(needs: dict[str, tuple[str, ...]], **rules: str) -> Grammar:
    """Rules by role. ``needs``: words without one of which a role's pattern cannot match; a line is asked for them first. A pattern that begins with
    ``^`` is tried at a line's start only."""
    found = ((role, pattern, re.compile(pattern)) for role, pattern in rules.items())
    return [(role, needs.get(role, ("",)), p.match if pattern.startswith("^") else p.search, p.groupindex.get("said", 0), p.groupindex.get("value", 0)) for role, pattern, p in found]


def events(lines: Iterable[str], rules: Grammar) -> list[Event]:
    """Each line under the first rule that it meets."""
    out = []
    for line in lines:
        for role, words, look, said, value in rules:
            for w in words:
                if w in line:
                    break
            else:
                continue
            if m := look(line):
                out.append(Event(role, m[said].strip() if said else "", m[value].strip() if value else "", line))
                break
        else:
            out.append(Event("", "", "", line))
    return out


def values(seen: Iterable[Event], closed_by: dict[str, set[str]]) -> dict[str, list[str]]:
    """Of each role in ``closed_by``, the values that its labels begin, with the lines up to the next event that closes it; each once."""
    out: dict[str, list[str]] = {role: [] for role in closed_by}
    open_: list[tuple[str, list[str]]] = []
    for role, _, value, line in seen:
        if open_:
            open_ = [x for x in open_ if role not in closed_by[x[0]]]
            for _, parts in open_:
                parts.append(line)
        if role in out:
            open_.append((role, parts := [value]))
            out[role].append(parts)
    tidy = lambda parts: one_line(" ".join(parts)).strip(" ；;，,")
    return {role: list(dict.fromkeys(x for x in map(tidy, found) if x)) for role, found in out.items()}


def part_of(lines: list[str], starts: list[str], stops: list[str]) -> list[str]:
    """The lines behind a heading up to the next section; all of them where that leaves none."""
    begin = next((i + 1 for i, x in enumerate(lines) for s in starts if s in x), 0)
    stops = _said(lines, stops)
    end = next((i for i in range(begin, len(lines)) for s in stops if s in lines[i]), len(lines))
    return lines[begin:end] or lines


# Words without which the rules of a candidates' notice cannot match.
_CANDIDATE_NEEDS = {"aside": ("中标候选人",), "lot": ("标段",), "name": ("中标候选人",), "quote": ("报价", "投标价格")}
_CANDIDATES = grammar(_CANDIDATE_NEEDS, aside=P.CANDIDATE_ASIDE, lot=P.LOT_HEADING, name=P.CANDIDATE, quote=P.QUOTE)
_FURTHER_QUOTE = re.compile(P.QUOTE)


def candidate_pairs(lines: list[str]) -> list[dict[str, str]]:
    """(lot, name, price) of a candidates' notice, one for each lot (or for the whole, without lots): the first candidate, and all quotes
    as the notice words them."""
    if not _said(lines, [*_CANDIDATE_NEEDS["name"], *_CANDIDATE_NEEDS["quote"]]):
        return []
    lots: list[tuple[str, list[str], list[str]]] = [("", [], [])]
    for e in events(part_of(lines, *P.CANDIDATE_PART), _CANDIDATES):
        if e.role == "lot":
            lots.append((e.said, [], []))
        elif e.role == "name" and not lots[-1][1]:
            lots[-1][1].append(one_line(e.value).strip(" ；;，,"))
        elif e.role in ("name", "quote") and (q := _FURTHER_QUOTE.search(e.line)):
            lots[-1][2].append(f"{q['said'].strip()}：{q['value'].strip()}")
    # what stands before the first lot belongs to none
    return [{"lot": lot, "name": "".join(names), "price": "；".join(quotes)} for lot, names, quotes in (lots[1:] or lots) if names or quotes]


# Words without which the rules of a result notice cannot match.
_AWARD_NEEDS = {"name": ("中标人", "中标单位", "中标供应商"), "price": ("中标价", "中标金额", "成交金额"), "winner_word": ("中标人", "中标单位"), "price_word": ("中标价", "中标金额", "成交金额")}
_AWARDS = grammar(_AWARD_NEEDS, name=P.WINNER, price=P.AWARD_PRICE, winner_word=P.WINNER_WORD, price_word=P.PRICE_WORD, end=P.AWARD_END)


def winner_pairs(lines: list[str]) -> tuple[list[str], list[str]]:
    """Names and prices of a result notice, each distinct one once. A name ends at a price and a price at a name."""
    if not _said(lines, [*_AWARD_NEEDS["name"], *_AWARD_NEEDS["price"]]):
        return [], []
    part = block(lines, *P.AWARD_PART)[1:] or [x for x in lines if "中标人信息" not in x]
    got = values(events(part, _AWARDS), {"name": {"price", "price_word", "end"}, "price": {"name", "winner_word", "end"}})
    return got["name"], got["price"]


_BARE_PERCENT, _RATE, _PRICE_LABEL = re.compile(P.BARE_PERCENT), re.compile("|".join(P.RATE_WORDS)), re.compile(P.PRICE_LABEL)


def explained(rate: str, lines: list[str]) -> str:
    """The first line that holds a rate and says what it is of, without its label; empty without one."""
    line = next((x for x in lines if _RATE.search(x) and rate in "".join(x.split())), "")
    return _PRICE_LABEL.sub("", line, count=1).strip() or line


def full_percent(price: str, lines: list[str]) -> str:
    """A bare percentage as the line that explains it; other prices, and percentages without such a line, as they are."""
    items = [x for x in map(str.strip, price.split("\n")) if x]
    return "\n".join((explained("".join(x.split()), lines) if _BARE_PERCENT.fullmatch(x) else "") or x for x in items)


def winners(text: str) -> list[str]:
    """Companies that a text names as winner, in the four ways of naming one; each once."""
    named = (m.split("中标价")[0].strip().rstrip(P.WINNER_EDGE) for way in P.WINNER_WAYS for m in re.findall(way, text or ""))
    return [x for x in dict.fromkeys(named) if len(x) >= 2]


# Headings of the qualification section, and what ends it.
QUALIFICATION = ["投标人资格要求", "投标人资格条件", "申请人资格要求", "申请投标人资格要求", "投标资格要求"]
QUALIFICATION_STOPS = ["招标文件的获取", "招标文件获取", "文件的获取", "电子招标文件", "预审文件的获取", "申请文件的递交", "投标文件的递交", "投标文件递交", "开标时间", "开标地点", "投标保证金", "提出异议", "异议的渠道", "联系方式", "监督部门", "招标代理机构", "盖章", "备案号", "晋ICP", "行政审批服务管理局", "投诉举报"]


def qualification(text: str) -> str:
    """The section behind the first of the headings that occurs, from its next line to the nearest stop; over 20 characters."""
    at = next((i for h in QUALIFICATION if (i := (text or "").find(h)) >= 0), None)
    if at is None or (line := text.find("\n", at)) < 0:
        return ""
    rest = text[line:]
    got = re.sub(r"\n+", " ", rest[: min([len(rest), *(i for s in QUALIFICATION_STOPS if (i := rest.find(s)) >= 0)])].strip()).strip()
    return got if len(got) > 20 else ""
