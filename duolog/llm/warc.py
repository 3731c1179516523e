"""WARC derivatives: responses become linked metadata and plain-text conversion records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import os
import re
import uuid
from urllib.parse import urljoin

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duolog.llm._arrow import slices

CRLF = "\r\n"
VERSION = "WARC/1.1" + CRLF
#: Capture time of responses whose source has none.
DATE = "2024-01-01T00:00:00Z"
SCHEMA = (
    "page_id long, warc_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_status string, source_headers string, source_content_type string, source_payload_digest string, n_outlinks int, content string"
)
# No pattern looks past the next angle bracket, so that a page takes time in proportion to its length.
_TAG = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]*)>|<[!?/][^<>]*>")
_LANG = re.compile(r"\blang\s{0,9}=\s{0,9}[\"']?([A-Za-z0-9-]+)", re.I)
_HREF = re.compile(r"(?:^|\s)href\s{0,9}=\s{0,9}(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))", re.I)
_CLOSE = {name: re.compile(f"</{name}[^<>]*>", re.I) for name in ("script", "style", "title")}
_BREAKS = frozenset("p div br h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr table article section header footer nav aside main blockquote pre hr body".split())
_UNSEEN = frozenset(("head", "noscript", "template"))
_SPACES = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_FIELDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _FIELDS[kind]) for name, kind in (x.split() for x in schema.split(", "))])


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, url, html) -> response records: page_id, record_id, target_uri, warc_date, block (HTTP head and payload).
    Null url and html count as empty; record ids follow from id, url and html, so only equal pages have equal ones."""
    url, page = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    seed = F.md5(F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.char_length(url), url, F.md5(page)))
    name = F.regexp_replace(seed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(page), F.lit(CRLF + CRLF))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), name.alias("record_id"), url.alias("target_uri"), F.lit(date).alias("warc_date"), F.concat(head, page).alias("block"))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def read_page(page: str, uri: str) -> tuple[str, str, list[str], str]:
    """Title, declared language, absolute outlinks in order of first mention, and visible text, in one pass.

    Text: comments, head, scripts and styles go, block tags break lines, other tags vanish, entities are resolved, white space
    is folded. Unclosed comments, scripts, styles and titles hide the rest; a head ends at the body at the latest. A tag ends
    at the next angle bracket; < before another < is text."""
    out: list[str] = []
    links: dict[str, None] = {}
    title, lang, unseen, at = None, "", "", 0
    for_next = _TAG.search
    while (tag := for_next(page, at)) is not None:
        if not unseen:
            out.append(page[at : tag.start()])
        at = tag.end()
        if tag.group(2) is None:
            if tag.group(0) == "<!--":
                end = page.find("-->", at)
                at = len(page) if end < 0 else end + 3
            continue
        name, closing = tag.group(2).lower(), tag.group(1)
        if name in _BREAKS:
            out.append("\n")
        if name == "body" and not closing or closing and name == unseen:
            unseen = ""
        elif closing:
            continue
        elif name in _CLOSE:
            end = _CLOSE[name].search(page, at)
            if name == "title" and title is None and end:
                title = page[at : end.start()]
            at = end.end() if end else len(page)
            out.append("\n")
        elif name in _UNSEEN and not unseen:
            unseen = name
            out.append("\n")
        elif name == "html" and not lang and (found := _LANG.search(tag.group(3))):
            lang = found[1]
        elif name == "a" and (found := _HREF.search(tag.group(3))):
            try:
                links[urljoin(uri, entities.unescape(found[1] or found[2] or found[3] or "").strip())] = None
            except ValueError:
                continue
    if not unseen:
        out.append(page[at:])
    text = entities.unescape("".join(out)).replace("\r", "\n")
    return " ".join(entities.unescape(title or "").split()), lang, list(links), _LINES.sub("\n", _SPACES.sub(" ", text)).strip()


def split_block(block: str) -> tuple[str, list[tuple[str, str]], str]:
    """HTTP status line, header fields in order with repeats, and payload. Without a blank line all is payload."""
    head, found, payload = block.partition(CRLF + CRLF)
    if not head.startswith("HTTP/") or not found:
        return "", [], block
    status, *lines = head.split(CRLF)
    fields: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and fields:  # a folded line goes on
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif line:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    return status, fields, payload


def _derived(record: dict) -> list[tuple]:
    status, fields, payload = split_block(record["block"] or "")
    uri, source = record["target_uri"] or "", record["record_id"] or ""
    source_digest = record.get("payload_digest") or digest(payload.encode())
    kind_of = next((value for name, value in reversed(fields) if name.lower() == "content-type"), "")
    title, lang, links, text = read_page(payload, uri)
    lines = [("title", title), ("language", lang), ("source-status", status), *((f"source-header-{name.lower()}", value) for name, value in fields), ("source-payload-digest", source_digest)]
    lines += [("outlink", link) for link in links]
    meta = "".join(f"{k}: {' '.join(v.split())}{CRLF}" for k, v in lines if v)
    headers = CRLF.join(f"{name}: {value}" for name, value in fields)
    names = {kind: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}|{source}|{source_digest}')}>" for kind in ("metadata", "conversion")}
    out = []
    for kind, other, mime, content in (("metadata", "conversion", "application/warc-fields", meta), ("conversion", "metadata", "text/plain; charset=utf-8", text)):
        data = content.encode()
        out.append((record["page_id"], kind, names[kind], source, names[other], uri, record["warc_date"], mime, len(data), digest(data), status, headers, kind_of, source_digest, len(links), content))
    return out


def derivatives(records: DataFrame) -> DataFrame:
    """Response records -> two rows per record (see SCHEMA): a metadata and a conversion record. Both name the response in
    refers_to and each other in concurrent_to, and keep its URI, date, status line, header fields (all, in order), content type
    and payload digest; each has a digest and length of its own. The metadata record's content lists them too.

    Rows are independent: nothing is shuffled, repeated responses give repeated records, an empty table gives none. Null blocks
    are empty payloads, other nulls empty texts. Only page_id, record_id, target_uri, warc_date, block and, where there is one, payload_digest (of
    the bytes that the block was decoded from, see `read_warc`) are read, whatever other columns are called. Work grows with a page's length, whatever it holds."""
    fields = _arrow(SCHEMA)

    def derive(batches):
        for part in slices(batches, "block"):
            rows = [row for record in part.to_pylist() for row in _derived(record)]
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return records.select("page_id", "record_id", "target_uri", "warc_date", "block", *[c for c in records.columns if c == "payload_digest"]).mapInArrow(derive, SCHEMA)


def record_text(records: DataFrame) -> DataFrame:
    """Whole WARC/1.1 records as a single string column `value`, without the two line ends that follow each."""
    field = lambda name, c: F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit(CRLF))
    named = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"),
        ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "source_payload_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    ]
    return records.select(F.concat(F.lit(VERSION), *[F.coalesce(field(n, c), F.lit("")) for n, c in named if c in records.columns], F.lit(CRLF), "content").alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files in a new folder, one per task that has records, written by the tasks themselves through pyarrow's file systems: path is a local
    (shared) folder or an address of one of them. "gzip": one member a record, as readers that seek by record want it; "none": plain.

    A task writes to a name of its own attempt and moves the file at its end, so tasks that are run again leave whole files only."""
    if compression not in ("gzip", "none"):
        raise ValueError("compression is gzip or none")
    store, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")
    if store.get_file_info(folder).type != fs.FileType.NotFound:
        raise ValueError(f"{path} exists")
    store.create_dir(folder)
    end = (CRLF + CRLF).encode()

    def write(batches):
        task = TaskContext.get()
        store, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")
        name = f"{folder}/part-{task.partitionId():06d}.warc" + ".gz" * (compression == "gzip")
        draft, out, n = f"{folder}/.draft-{task.taskAttemptId()}", None, 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                out = out or store.open_output_stream(draft, compression=None)
                out.write(gzip.compress(raw + end, mtime=0) if compression == "gzip" else raw + end)
                n += 1
        if out is not None:
            out.close()
            store.move(draft, name)
        yield pa.record_batch([pa.array([n], pa.int64())], ["n"])

    record_text(records).select(F.col("value").cast("binary")).mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


READ = "page_id long, version string, warc_type string, record_id string, refers_to string, concurrent_to string, target_uri string, warc_date string, block_digest string, content_type string, content string, block string, payload_digest string, whole boolean"
#: Where records begin, up to the minor version.
_START = b"WARC/1."
_VERSION = re.compile(rb"[0-9]+\r\n")
_CHARSET = re.compile(r"charset\s{0,9}=\s{0,9}[\"']?([A-Za-z0-9_.:-]+)", re.I)


def decoded(data: bytes, charset: str) -> str:
    """Bytes as text of a charset, UTF-8 where it is unknown; what is no text of it becomes the replacement character."""
    try:
        return data.decode(charset, errors="replace")
    except (LookupError, ValueError):
        return data.decode(errors="replace")


def decoded_block(block: bytes) -> tuple[str, str]:
    """An HTTP response as text, and the digest of its payload's bytes. The charset is that of Content-Type, else that which the page's first 2,048 bytes
    name, else UTF-8; a head is read as UTF-8, or as Latin-1 where it is none."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not head.startswith(b"HTTP/") or not found:
        head, found, payload = b"", b"", block
    try:
        top = head.decode()
    except UnicodeDecodeError:
        top = head.decode("latin-1")
    kinds = [line for line in top.split(CRLF) if line.lower().startswith("content-type:")]
    named = _CHARSET.search(kinds[-1]) if kinds else None
    named = named or _CHARSET.search(payload[:2048].decode("latin-1"))
    return top + found.decode() + decoded(payload, named[1] if named else "utf-8"), digest(payload)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC/1.x files, plain or compressed, see READ. `block` is the content of a response, decoded by its charset (see
    `decoded_block`), and null for other records, so that response records can go to `derivatives`; page_id is null. Other contents are read as UTF-8, with
    replacement characters for what is none.

    Spark cuts files at version lines, as bytes. A record whose content is shorter than declared goes on through the next cuts, so version
    lines inside a payload do no harm. `whole` tells whether the declared length was met; it can be false at the edge of a split
    of an uncompressed file, or for a record with a wrong length, which is returned as far as it goes. Bytes before a file's first record that are not blank are returned as a
    record without type that is not whole. Files without records give no rows."""
    raw = spark.read.option("lineSep", _START.decode()).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    names = ("warc-type", "warc-record-id", "warc-refers-to", "warc-concurrent-to", "warc-target-uri", "warc-date", "warc-block-digest", "content-type")
    fields = _arrow(READ)

    def parse(record: bytes) -> tuple[str, dict, bytes, int]:
        version = _VERSION.match(record)
        head, _, content = record.partition(b"\r\n\r\n")
        found = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in head.decode(errors="replace").split(CRLF)[1:])}
        size = found.get("content-length", "")
        if version is None:
            return "", {}, record, -1
        return f"WARC/1.{version[0].decode().strip()}", found, content, int(size) if size.isdigit() else -1

    def row(version: str, found: dict, data: bytes, size: int) -> tuple:
        whole = size >= 0 and len(data) >= size and bytes(data[size:]).strip(b"\r\n") == b""
        content = bytes(data[:size]) if whole else bytes(data).removesuffix(b"\r\n\r\n")
        kept = [found.get(n, "") for n in names]
        if kept[0] != "response":
            return (None, version, *kept, content.decode(errors="replace"), None, None, whole)
        block, sha = decoded_block(content)
        return (None, version, *kept, block, block, sha, whole)

    def join(batches):
        open_record, last = None, None  # version, header fields, bytes so far, declared size
        for batch in batches:
            done = []
            for value, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                same, last = file == last, file
                if open_record is not None and same and (len(open_record[2]) < open_record[3] or _VERSION.match(value) is None):
                    open_record[2] += _START + value
                    continue
                if open_record is not None:
                    done.append(row(*open_record))
                    open_record = None
                if value.strip():
                    version, found, content, size = parse(value)
                    open_record = [version, found, bytearray(content), size]
            if done:
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*done), fields)], schema=fields)
        if open_record is not None:
            yield pa.record_batch([pa.array([c], f.type) for c, f in zip(row(*open_record), fields)], schema=fields)

    return raw.mapInArrow(join, READ)
