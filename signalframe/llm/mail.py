"""The text that a mail's author wrote, out of the archived message.

Headers, multipart bodies, transfer encodings and character sets (also wrongly declared ones) are decoded; quoted
messages, signatures, attachments and markup are left out; whether a paragraph is a legal notice is for the reader to judge. Whatever is broken is read as far as it goes.
"""

from __future__ import annotations

import base64
import binascii
import html
import quopri
import re
from collections.abc import Iterator

_HEADER = re.compile(r"^([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*)$")
_PARAMETER = re.compile(r";\s*([\w-]+)\*?\s*=\s*(?:\"([^\"]*)\"|([^;\s]+))")
_MOJIBAKE = re.compile(r"[ÂÃ][\x80-¿ŠšŒœŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]")


def split_headers(text: str) -> tuple[dict[str, str], str]:
    """Headers by lower-case name (the first of each), and what follows the first blank line."""
    head, _, body = text.partition("\n\n")
    headers: dict[str, str] = {}
    name = None
    for line in head.split("\n"):
        if line[:1] in " \t" and name:
            headers[name] += " " + line.strip()
        elif m := _HEADER.match(line):
            name = m[1].lower()
            if name in headers:
                name = None
            else:
                headers[name] = m[2]
        else:
            name = None
    return headers, body


def _parameters(value: str) -> dict[str, str]:
    return {k.lower(): a or b for k, a, b in _PARAMETER.findall(value)}


def repair(text: str) -> str:
    """Undo UTF-8 that was read as a one-byte character set."""
    if ("Ã" in text or "Â" in text) and _MOJIBAKE.search(text):
        for charset in ("cp1252", "latin-1"):
            try:
                return text.encode(charset).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
    return text


def decode_bytes(data: bytes, charset: str) -> str:
    """UTF-8 if the bytes are that (mail is often declared wrongly), else the declared set, else Windows-1252."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        pass
    if charset.lower().replace("_", "-") not in ("", "utf-8", "us-ascii", "ascii"):
        try:
            return data.decode(charset)
        except (LookupError, UnicodeDecodeError):
            pass
    return data.decode("cp1252", "replace")


def decode_body(body: str, encoding: str, charset: str) -> str:
    encoding = encoding.strip().lower()
    if encoding == "base64":
        letters = re.sub(r"[^A-Za-z0-9+/]", "", body.split("\n\n--")[0])
        try:
            return decode_bytes(base64.b64decode(letters[: len(letters) // 4 * 4] + (letters[len(letters) // 4 * 4 :] + "==")[:4] * (len(letters) % 4 > 1)), charset)
        except (binascii.Error, ValueError):
            return ""
    if encoding == "quoted-printable":
        return decode_bytes(quopri.decodestring(body.encode("utf-8", "replace")), charset)
    return body


def html_text(markup: str) -> str:
    """Text of HTML without quoted blocks, styles and scripts."""
    markup = re.sub(r"(?is)<!--.*?-->|<(style|script|head|title)\b.*?</\1\s*>", " ", markup)
    markup = re.sub(r"(?is)<blockquote\b.*?(</blockquote\s*>|\Z)", "\n> \n", markup)
    markup = re.sub(r"(?i)<hr\b[^>]*>", "\n________\n", markup)
    markup = re.sub(r"(?i)<(br|/p|/div|/tr|/li|p|div|h[1-6]|/h[1-6])\b[^>]*>[ \t]*\n?", "\n", markup)
    return html.unescape(re.sub(r"(?s)<[^<>]*>", "", markup)).replace("\xa0", " ")


def _split_parts(body: str, boundary: str | None) -> list[tuple[dict[str, str], str]]:
    """Headers and body of each part between boundaries; an unnamed boundary is the first line that looks like one."""
    if boundary is None:
        m = re.search(r"(?m)^--(\S+)\s*$", body)
        boundary = m[1] if m else ""
    parts = []
    for p in ("\n" + body).split(f"\n--{boundary}")[1:]:
        rest, _, p = p.partition("\n")
        if rest.strip() in ("", "--"):  # else another boundary that begins alike
            parts.append(split_headers(p) if _HEADER.match(p.split("\n", 1)[0]) else ({}, p))
    return parts


def _open_part(headers: dict[str, str], body: str, nested: bool) -> str | tuple[str, list[tuple[dict[str, str], str]]]:
    """The text of a single part, or the kind and the parts of a multipart."""
    kind = headers.get("content-type", "text/plain")
    main, parameters = kind.split(";")[0].strip().lower(), _parameters(kind)
    disposition = headers.get("content-disposition", "").lower()
    if "attachment" in disposition or "filename" in disposition:
        return ""
    if main.startswith("multipart/"):
        parts = _split_parts(body, parameters.get("boundary"))
        if main == "multipart/alternative":  # the plain one if it says anything
            parts.sort(key=lambda part: not part[0].get("content-type", "text/plain").lower().startswith("text/plain"))
        return main, parts
    if main == "message/rfc822" or (main and not main.startswith("text/") and nested):
        return ""
    text = decode_body(body, headers.get("content-transfer-encoding", ""), parameters.get("charset", ""))
    if main == "text/html" or re.search(r"(?i)^\s*<(!doctype|html|body)\b", text):
        text = html_text(text)
    return repair(text.replace("\r\n", "\n").replace("\r", "\n"))


def body_text(headers: dict[str, str], body: str) -> str:
    """The readable text of a body: of alternatives the plain one, of mixed parts those that aren't attachments.

    Multiparts are walked with a stack of their own, however deep they are nested.
    """
    stack: list[tuple[str, Iterator[tuple[dict[str, str], str]], list[str]]] = [("", iter([(headers, body)]), [])]
    while True:
        kind, parts, read = stack[-1]
        part = None if read and kind in ("multipart/alternative", "multipart/related") else next(parts, None)
        opened: str | tuple = ""
        if part is not None:
            opened = _open_part(*part, nested=len(stack) > 1)
        else:
            opened = "\n".join(read)
            stack.pop()
            if not stack:
                return opened
        if isinstance(opened, tuple):
            stack.append((opened[0], iter(opened[1]), []))
        elif opened.strip():
            stack[-1][2].append(opened)


def message_text(text: str | None) -> tuple[dict[str, str], str]:
    """Headers and decoded body text of a whole message; a text without headers is all body."""
    if not text or not text.strip():
        return {}, ""
    text = text.replace("\r\n", "\n").replace("\r", "\n").lstrip("\n﻿")
    if not _HEADER.match(text.split("\n", 1)[0]):
        return {}, body_text({}, text)
    headers, body = split_headers(text)
    return headers, body_text(headers, body)


_QUOTE = re.compile(r"^\s*(?:>|\|\s)")
_WROTE = re.compile(r"(?i)\b(wrote|schrieb|écrit|ecrit|escribió|escribio)\b.*:\s*$")
_OPENS = re.compile(r"^(On|Am|Le|El)\b")
_OLD_MESSAGE = re.compile(r"^-{3,}\s*\w.*\w\s*-{3,}\s*$")
_FIELD = re.compile(r"(?i)^\*?(from|von|de|sent|gesendet|envoyé|enviado|date|datum|to|an|para|subject|betreff|objet|asunto)\s?:\*?\s")
_RULE = re.compile(r"^\s*([_*=~-])\1{2,}\s*$")
_RULES, _ENCODED = frozenset("_*=~- \t"), re.compile(r"^begin [0-7]{3} \S")
_SIGNATURE = re.compile(r"^--\s*$")
_END = re.compile(r"(?<=[.!?…])[\"»”')]*\s+(?=[^\s])")


def own_lines(body: str) -> list[str]:
    """Lines of a body without quotes, their introductions, signature, and encoded attachments; a rule parts paragraphs."""
    lines, out, i = body.split("\n"), [], 0
    while i < len(lines):
        line = lines[i].rstrip()
        head = line[:1]
        if head == "b" and _ENCODED.match(line):
            while i < len(lines) and lines[i].strip() != "end":
                i += 1
        elif head in _RULES and (_SIGNATURE.match(line) or _OLD_MESSAGE.match(line)):
            break
        elif head in _RULES and _RULE.match(line):
            out.append("")
        elif ":" in line and _FIELD.match(line) and i + 1 < len(lines) and _FIELD.match(lines[i + 1]):
            break
        elif (">" in line or "|" in line) and _QUOTE.match(line):
            out.append("")
        elif line.endswith(":") and _WROTE.search(line):
            if out and _OPENS.match(out[-1]) and not out[-1].endswith((".", "!", "?")):
                out.pop()
            out.append("")
        else:
            out.append(line)
        i += 1
    return out


def own_sentences(body: str) -> list[str]:
    """Sentences that the author wrote, whether or not they end with a full stop; what a paragraph breaks off with is one too."""
    out = []
    for paragraph in re.split(r"\n\s*\n", "\n".join(own_lines(body))):
        out += [s for s in _END.split(" ".join(paragraph.split())) if s]
    return out
