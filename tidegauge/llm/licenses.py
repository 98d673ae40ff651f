"""Licence scans: an Aho-Corasick automaton for phrases and tags, a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.arrow import map_texts

#: Phrases of whole words that every scan counts, and their labels. Fixed values.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Further notice phrases of whole words, their labels and how surely they state a licence.
NOTICES = {
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.9),
    "isc license": ("isc", 0.9),
    "creative commons": ("cc", 0.7),
    "licensed under cc by": ("cc-by", 0.9),
    "licensed under cc by sa": ("cc-by-sa", 0.9),
    "licensed under cc by nc": ("cc-by-nc", 0.9),
    "licensed under cc by nd": ("cc-by-nd", 0.9),
    "licensed under cc by nc sa": ("cc-by-nc-sa", 0.9),
    "licensed under cc by nc nd": ("cc-by-nc-nd", 0.9),
    "cc0 1 0": ("cc0", 0.8),
    "released into the public domain": ("public-domain", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "all rights reserved": ("proprietary", 0.5),
}
BASE_WEIGHT, TAG_WEIGHT = 0.9, 0.98
#: Tags that an expression follows on their line, in lower case, and how surely they state one.
TAGS = {
    "spdx-license-identifier:": TAG_WEIGHT,
    "license:": 0.9,
    "licence:": 0.9,
    '"license":': 0.9,
    "license=": 0.8,
    "license =": 0.8,
    "@license": 0.8,
}
#: Names that licence identifiers begin with; what may follow one is ruled by ``is_licence``.
#: Fixed values.
LICENCE_NAMES = frozenset(
    "0bsd aal adsl afl agpl amdplpa aml antlr-pd apache apafml apsl artistic barr beerware bittorrent "
    "blueoak bsd bsl bzip2 caldera catosl cc-by cc-by-nc cc-by-nc-nd cc-by-nc-sa cc-by-nd cc-by-sa "
    "cc0 cddl cdla-permissive cdla-sharing cecill clartistic cnri-python condor cpal cpl cpol curl "
    "doc ecl ecos efl elastic entessa epl erlpl etalab eudatagrid eupl eurosym fair frameworx freetype "
    "fsfap fsful ftl fsl gfdl giftware gl2ps glide gpl hpnd icu ijg imagemagick imatix info-zip intel "
    "ipa ipl isc jasper jpnic json lal leptonica lgpl lgpllr libpng libtiff liliq-p liliq-r lpl lppl miros "
    "mit mpich2 mpl ms-pl ms-rl mtll mulanpsl multics naist nasa nbpl ncsa netcdf newsletr ngpl nlod nlpl "
    "nokia nosl noweb npl nposl ntp oclc odbl odc-by ofl ogl-uk ogtsl oldap openssl oset osl pddl php plexus "
    "postgresql psf psutils python qhull qpl rpl rpsl rsa-md ruby sax-pd scea sendmail sgi-b simpl "
    "sissl sleepycat spl sspl sugarcrm tcl tmate unicode unicode-dfs unlicense upl vim vostrom vsl w3c "
    "watcom wtfpl x11 xerox xfree86 xinetd xnet xpp zed zend zimbra zlib zpl".split()
)
#: Parts that may follow a name beside version numbers. Fixed values.
LICENCE_PARTS = frozenset(
    "only or later clause clear lbnl patent views uc attribution shortened open mpi modification no "
    "nuclear license warranty perl cl8 cmu enna feh modern variant festival invariants invariant "
    "acknowledgement advertising lite doc fsf unmodified tso b c l bugfix libpng au de uk us jp nl at "
    "igo eu with classpath exception gcc font bison autoconf".split()
)
#: Exceptions whose names don't end with ``exception``. Fixed values.
EXCEPTIONS = frozenset(
    "linux-syscall-note gpl-cc-1.0 gstreamer-exception-2005 ps-or-pdf-font-exception-20170817 "
    "universal-foss-exception-1.0 fmt-exception".split()
)
#: The next token of an expression on its line, and the quotes that may stand around one.
_NEXT = re.compile(r"[ \t]*([()]|[a-z0-9.+:_-]+)")
_QUOTE = re.compile(r"[ \t]*[\"'`]?")
_VERSION = re.compile(r"v?[0-9]+(\.[0-9]+)*[a-z]?")
_ATTACHED = re.compile(r"([a-z]+?)(v?[0-9]+(?:\.[0-9]+)*)")
_EXCEPTION = re.compile(r"[a-z0-9.-]+-exception(-[0-9]+(\.[0-9]+)*)?")
_REFERENCE = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9._-]+")
OPERATORS = {"or": 1, "and": 2, "with": 3}

#: A-Z to lower case, other ASCII but digits and a-z to blanks; bytes of other characters stay.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 32
    for c in range(256)
)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def words(text: str) -> list[bytes]:
    """Words as UTF-8: runs of digits, letters a-z and characters beyond ASCII, lower-cased."""
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split()


def parse_expression(text: str) -> list[str]:
    """A licence expression in postfix order by the shunting-yard algorithm.

    ``or`` binds least, then ``and``, then ``with``; all lean left. Raises ``ValueError`` for
    what is not an expression.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in re.findall(r"[()]|[^\s()]+", text.lower()):
        if token in OPERATORS:
            if operand_next:
                raise ValueError(f"{token} lacks its left side")
            while stack and stack[-1] != "(" and OPERATORS[stack[-1]] >= OPERATORS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise ValueError("an operator is missing")
            stack.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("an operand is missing")
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError("a bracket was never opened")
            stack.pop()
        else:
            if not operand_next:
                raise ValueError("an operator is missing")
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        raise ValueError("the expression ends early")
    return out + stack[::-1]


def is_licence(word: str) -> bool:
    """Whether a lower-case word names a licence.

    It begins with one of ``LICENCE_NAMES``; version numbers and ``LICENCE_PARTS`` may follow
    behind hyphens, one number without (``gplv2``), and a plus sign; or it is a ``LicenseRef``.
    """
    if _REFERENCE.fullmatch(word):
        return True
    parts = word.removesuffix("+").split("-")
    for size in range(len(parts), 0, -1):
        name = "-".join(parts[:size])
        attached = _ATTACHED.fullmatch(name)
        if name in LICENCE_NAMES or (attached and attached[1] in LICENCE_NAMES):
            return all(x in LICENCE_PARTS or _VERSION.fullmatch(x) for x in parts[size:])
    return False


def is_exception(word: str) -> bool:
    """Whether a lower-case word names an exception to a licence."""
    return word in EXCEPTIONS or bool(_EXCEPTION.fullmatch(word))


def leading_expression(text: str, begin: int = 0) -> str:
    """The longest expression that a lower-case text has at a place; empty if there is none.

    Reads no further than it must: a word that names no licence ends it, or behind ``with`` no
    exception, and so does a full stop or colon behind a word. A long text costs no more than its
    expressions.
    """
    at = end = begin
    depth, operand_next, last = 0, True, ""  # the last token, "licence" for a licence
    while match := _NEXT.match(text, at):
        token, at = match[1], match.end()
        if token == "(":
            if not operand_next:
                break
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            depth -= 1
            if not depth:
                end = at
        elif token in OPERATORS:
            if operand_next or (token == "with" and last != "licence"):
                break
            operand_next = True
        else:
            word = token.rstrip(".:")
            if not operand_next or not (is_exception if last == "with" else is_licence)(word):
                break
            operand_next = False
            if not depth:
                end = match.start(1) + len(word)
            if word != token:
                break
            token = "exception" if last == "with" else "licence"
        last = token
    return text[begin:end].strip()


def evaluate(postfix: list[str], allowed: Callable[[str], bool]) -> tuple[bool, list[str]]:
    """Whether an expression can be met with allowed licences, and the licences it names.

    ``a or b`` needs one side, ``a and b`` both; ``a with e`` is asked as one licence first, then
    as ``a`` alone, since an exception only grants more.
    """
    stack: list[tuple[bool, str]] = []
    named: list[str] = []
    for token in postfix:
        if token not in OPERATORS:
            stack.append((allowed(token), token))
            named.append(token)
            continue
        (right, exception), (left, name) = stack.pop(), stack.pop()
        if token == "with":
            named.remove(exception)
            stack.append((allowed(f"{name} with {exception}") or left, name))
        else:
            stack.append((left or right if token == "or" else left and right, ""))
    return stack[0][0], named


def family(licence: str) -> str:
    """The label of an identifier: ``gpl-2.0-only`` and ``gpl-3.0+`` are ``gpl``."""
    if _REFERENCE.fullmatch(licence):
        return licence
    name = re.sub(r"-?v?\d[\d.]*.*$", "", licence.rstrip("+"))
    return name.removesuffix("-clause").removesuffix("-") or licence


def permissive(licence: str) -> bool:
    return family(licence) in {"mit", "apache", "bsd", "isc", "zlib", "cc", "cc-by", "unlicense"}


class LicenceScanner:
    """Finds phrases by words and tags by characters with one automaton each."""

    def __init__(self, allowed: Callable[[str], bool] = permissive):
        self.allowed = allowed
        self.phrases = ahocorasick.Automaton()
        for phrase, label in BASE_PHRASES.items():
            self.phrases.add_word(f" {phrase} ", (phrase, label, BASE_WEIGHT, True))
        for phrase, (label, weight) in NOTICES.items():
            self.phrases.add_word(f" {phrase} ", (phrase, label, weight, False))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag, weight in TAGS.items():
            self.tags.add_word(tag, (len(tag), weight))
        self.tags.make_automaton()

    def expressions(self, text: str) -> list[tuple[str, float]]:
        """The longest expressions right behind tags, on the line of each, and the tags' weights.

        A tag begins where a word may; one that another tag ends with at the same place, as in
        ``"license":``, is left to the longer one.
        """
        data = text.encode("utf-8", "replace").translate(_LOWER).decode("latin-1")
        found, behind = [], -1
        for end, (size, weight) in self.tags.iter(data):
            begin = end + 1 - size
            if end == behind or (begin and data[begin].isalpha() and data[begin - 1].isalnum()):
                continue
            behind = end
            start = _QUOTE.match(data, end + 1).end()
            if expression := leading_expression(data, start):
                found.append((expression, weight))
        return found

    def scan(self, text: str | None) -> tuple:
        """``(n_words, places, labels, expressions, met, score)`` of a whole text.

        ``places`` lists ``(first word, label)`` of every base phrase; ``met`` says whether every
        tagged expression can be met with allowed licences (None without any).
        """
        if not text:
            return 0, [], [], [], None, 0.0
        parts = words(text)
        # one character for each byte, a blank before and behind each word
        line = f" {b' '.join(parts).decode('latin-1')} "
        places, at, counted = [], 0, 0
        noticed: dict[int, tuple[str, str, float]] = {}  # the longest notice at each start
        labels, doubt = set(), 1.0
        for end, (phrase, label, weight, base) in self.phrases.iter(line):
            start = end - len(phrase) - 1
            if base:
                # ends never go back, starts by less than the longest phrase
                counted += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
                at = start
                places.append((counted, label))
            if start not in noticed or len(phrase) > len(noticed[start][0]) or base:
                noticed[start] = (phrase, label, weight)
        for _, label, weight in noticed.values():
            if label not in labels:
                labels.add(label)
                doubt *= 1 - weight
        expressions, met = [], None
        for expression, weight in self.expressions(text):
            fits, named = evaluate(parse_expression(expression), self.allowed)
            expressions.append(expression)
            met = fits and met is not False
            for label in map(family, named):
                if label not in labels:
                    labels.add(label)
                    doubt *= 1 - weight
        return len(parts), places, sorted(labels), expressions, met, 1 - doubt if labels else 0.0


SCHEMA = (
    "n_words bigint, places array<bigint>, place_labels array<string>, labels array<string>, "
    "expressions array<string>, met boolean, score double"
)


def scan_licences(
    frame: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    allowed: Callable[[str], bool] = permissive,
) -> DataFrame:
    """Licence evidence in every whole text; one row for each row.

    ``places`` and ``place_labels`` list each place of a base phrase by its first word, from 0;
    ``labels`` also holds those of notices and of identifier tags, ``expressions`` the tagged
    expressions, ``met`` whether all of them can be met with ``allowed`` licences. Null and empty
    texts have no words, no labels and score 0; a very long text is read as a whole. Repeated rows each give their row; other columns
    are left behind, whatever their names.
    """

    def make():
        scanner = LicenceScanner(allowed)

        def work(batch: pa.RecordBatch) -> dict:
            found = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            return {
                id_column: batch.column(0),
                "n_words": [f[0] for f in found],
                "places": [[p for p, _ in f[1]] for f in found],
                "place_labels": [[label for _, label in f[1]] for f in found],
                "labels": [f[2] for f in found],
                "expressions": [f[3] for f in found],
                "met": [f[4] for f in found],
                "score": [f[5] for f in found],
            }

        return work

    kind = frame.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {SCHEMA}"
    return map_texts(frame.select(id_column, text_column), text_column, make, schema)
