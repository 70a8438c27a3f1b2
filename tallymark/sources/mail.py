"""Message archives (.eml) and the filters on messages."""

from __future__ import annotations

from collections.abc import Iterator
from email.message import EmailMessage
from email.parser import BytesParser
from email.policy import EmailPolicy

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .. import constants as K
from ..functions.strings import ends_with_any, has_any
from ..schema import MESSAGE


_READABLE = ("text/html", "text/plain")
_BATCH_MAILS, _BATCH_BYTES = 1000, 8 << 20  # read before they are handed on together


class _ParsedOnce(EmailPolicy):
    """The default policy parses a header at each look at it; here equal ones are parsed once by a task."""

    def __init__(self):
        super().__init__(seen={})

    seen: dict = None  # a policy takes no attribute its class does not name

    def header_fetch_parse(self, name: str, value):
        if type(value) is not str or len(value) > 1000:
            return super().header_fetch_parse(name, value)
        found = self.seen.get((name, value))
        if found is None:
            if len(self.seen) >= 4096:
                self.seen.clear()
            found = self.seen[name, value] = super().header_fetch_parse(name, value)
        return found


def _attempt(read):
    """What ``read`` gives, or None where the mail is too odd for it: one part must not cost the others."""
    try:
        return read()
    except Exception:  # noqa: BLE001 - the parser raises many kinds on hostile input
        return None


def _clean(value) -> str | None:
    """A header as valid text; raw bytes that are no text are replaced."""
    return None if value is None else str(value).encode("utf-8", "replace").decode("utf-8")


def _part_text(part: EmailMessage) -> str | None:
    text = _attempt(part.get_content)
    if text is None:  # an unknown character set
        raw = _attempt(lambda: part.get_payload(decode=True))
        text = None if raw is None else raw.decode("utf-8", "replace")
    return _clean(text)


def _message_record(path: str, content: bytes, policy: EmailPolicy) -> dict:
    """The fields of one mail. What cannot be read is NULL; the mail itself is never lost."""
    message = _attempt(lambda: BytesParser(policy=policy).parsebytes(content)) or EmailMessage()
    leaves = [p for p in _attempt(lambda: list(message.walk())) or [] if not p.is_multipart()]
    named = [(p, _clean(_attempt(p.get_filename))) for p in leaves]
    texts = (
        _part_text(p) for p in leaves
        if (not message.is_multipart() or p.get_content_type() in _READABLE) and not _attempt(p.is_attachment)
    )
    return {
        "path": path,
        "subject": _clean(_attempt(lambda: message["Subject"])),
        "from": _clean(_attempt(lambda: message["From"])),
        "date": _clean(_attempt(lambda: message["Date"])),
        "body": next((t for t in texts if t is not None), ""),
        "attachments": [
            {"name": name, "content": _attempt(lambda p=p: p.get_payload(decode=True))} for p, name in named if name
        ],
    }


def decode_messages(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows of .eml files to messages."""
    schema = to_arrow_schema(MESSAGE)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size, policy = [], 0, _ParsedOnce()
        for batch in batches:
            for path, content in zip(*batch.columns):
                raw = content.as_py()
                records.append(_message_record(path.as_py(), raw, policy))
                size += len(raw or b"")
                if len(records) >= _BATCH_MAILS or size >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(records, schema=schema)
                    records, size = [], 0
        if records:
            yield pa.RecordBatch.from_pylist(records, schema=schema)

    return files.select("path", "content").mapInArrow(decode, MESSAGE)


def is_export_mail(subject: Column, sender: Column) -> Column:
    return F.lower(sender).contains(K.SENDER_WORD) & has_any(F.lower(subject), K.EXPORT_SUBJECT_WORDS)


def is_digest_mail(subject: Column, sender: Column) -> Column:
    return F.lower(sender).contains(K.SENDER_WORD) & has_any(F.lower(subject), K.DIGEST_SUBJECT_WORDS)


def digests(messages: DataFrame) -> DataFrame:
    """Digest mails. Those with attachments are exports and left to ``attached_files``."""
    return messages.where(is_digest_mail(F.col("subject"), F.col("from")) & (F.size("attachments") == 0)).drop(
        "attachments"
    )


def attached_files(messages: DataFrame) -> DataFrame:
    """The export files attached to export mails, shaped like ``binaryFile`` rows."""
    name = F.col("attachment.name")
    safe = F.regexp_replace(name, r"[/\\]", "_")
    return (
        messages.where(is_export_mail(F.col("subject"), F.col("from")))
        .select("path", "date", F.explode("attachments").alias("attachment"))
        .where(ends_with_any(F.lower(name), K.EXPORT_EXTENSIONS))
        .select(
            F.concat("path", F.lit("/"), safe).alias("path"),
            F.lit(None).cast("timestamp").alias("modificationTime"),
            F.length("attachment.content").cast("bigint").alias("length"),
            F.col("attachment.content").alias("content"),
        )
    )
