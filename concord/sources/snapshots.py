"""Remote snapshots: responses as text, one row for each request, with a status for each.

A response table has the request's key, `body` (JSON text, null where none came) and optionally `failure` (timeout, request_error).
It comes from files that a fetcher left (`read_responses`) or from a service directly (`fetch`).

Asking a service is a side effect: a task that Spark repeats asks again. With a journal, a folder that all tasks share, every answer is put down there
under its question as soon as it comes, and a question that has its answer there is not asked again, by whichever task or run. Questions that failed are."""

from __future__ import annotations

import hashlib
import json
import urllib.parse
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.values import has_key, unwrap
from concord.sources import schemas


def read_responses(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Response rows from JSON lines with the given key, body (an object or text) and failure."""
    return spark.read.schema(f"{key} string, body string, failure string").json(path)


def _ask(url: str, token: str | None, timeout: float, data: bytes | None = None) -> tuple[int | None, str | None, str | None]:
    """Status code, body and kind of failure of one request; a POST where there is data."""
    import urllib.error
    import urllib.request

    headers = ({"Authorization": f"Bearer {token}"} if token else {}) | ({"Content-Type": "application/json"} if data is not None else {})
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=headers), timeout=timeout) as answer:
            return answer.status, answer.read().decode(), None
    except TimeoutError:
        return None, None, "timeout"
    except (urllib.error.URLError, OSError) as e:
        code = getattr(e, "code", None)
        return code, None, "not_found" if code == 404 else "timeout" if isinstance(getattr(e, "reason", None), TimeoutError) else "request_error"


class Journal:
    """Answers by question, one small file each, in any folder that pyarrow can write to (a path or URI)."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.files, self.folder = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        self.missing = fs.FileType.NotFound

    def once(self, question: str, ask: Callable[[], tuple]) -> tuple:
        """The answer put down for question, or that of ask(), which is put down if it came."""
        name = hashlib.sha256(question.encode("utf-8", "surrogatepass")).hexdigest()
        folder, path = f"{self.folder}/{name[:2]}", f"{self.folder}/{name[:2]}/{name}.json"
        if self.files.get_file_info(path).type != self.missing:
            with self.files.open_input_stream(path) as f:
                return tuple(json.loads(f.read()))
        answer = ask()
        if answer[0] is not None:
            self.files.create_dir(folder, recursive=True)
            draft = f"{folder}/.{name}-{uuid.uuid4().hex}"  # whole or not at all
            with self.files.open_output_stream(draft) as f:
                f.write(json.dumps(answer).encode())
            self.files.move(draft, path)
        return answer


def _asker(journal: str | None) -> Callable[[str, Callable[[], tuple]], tuple]:
    return Journal(journal).once if journal else lambda _, ask: ask()


def fetch(requests: DataFrame, key: str, base_url: str, token: str | None = None, timeout: float = 5.0, journal: str | None = None) -> DataFrame:
    """Responses of GET base_url + key for each distinct key of requests; a failed request is a row with its kind of failure. journal: see above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _asker(journal)
        for b in batches:
            urls = [base_url + urllib.parse.quote(str(k)) for k in b.column(0).to_pylist()]
            asked = [once(f"GET {url}", lambda url=url: _ask(url, token, timeout)) for url in urls]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), *(pa.array([a[i] for a in asked], type=pa.string()) for i in (1, 2))], names=[key, "body", "failure"])

    return requests.select(key).distinct().mapInArrow(run, f"{key} string, body string, failure string")


def send_logouts(notices: DataFrame, url: str, token: str | None = None, timeout: float = 15.0, journal: str | None = None, batch: str = "") -> DataFrame:
    """POSTs a logout notice for each row (user_name, user_agent); user_name, code, failure and whether the service took it.

    With a journal (see above) a notice that was answered is not sent again in the same batch, so a task or a run that is repeated sends only what is open. Without one it sends all again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _asker(journal)
        for b in batches:
            bodies = [json.dumps({"user_name": u, "user_agent": a}) for u, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            asked = [once(f"POST {batch} {url} {body}", lambda body=body: _ask(url, token, timeout, body.encode())) for body in bodies]
            columns = [pa.array([a[i] for a in asked], type=t) for i, t in ((0, pa.int32()), (1, pa.string()), (2, pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["user_name", "code", "body", "failure"])

    sent = notices.select("user_name", "user_agent").mapInArrow(run, "user_name string, code int, body string, failure string")
    return sent.select("user_name", "code", "failure", logout_accepted(F.col("code"), F.col("body"), F.col("user_name")).alias("accepted"))


def request_kind(sub_id: str | None, member_name: str | None) -> str:
    """By which of two arguments a profile is asked for; exactly one must be given."""
    if (sub_id is None) == (member_name is None):
        raise ValueError("exactly one of sub_id and member_name must be given")
    return "subject" if sub_id is not None else "member"


def _status(parsed: Column, complete: Column) -> Column:
    body = F.col("body")
    return F.when(F.col("failure").isNotNull(), F.col("failure")).when(body.isNull(), "not_found").when(parsed.isNull() | ~complete, "parse_error").otherwise("ok")


def _profile(raw: Column) -> Column:
    """A parsed profile, null where the text is no object or a required key is absent (a null value will do)."""
    complete = F.json_object_keys(raw).isNotNull()
    for k in schemas.REQUIRED_PROFILE_KEYS:
        complete = complete & has_key(raw, k)
    return F.when(complete, F.from_json(raw, schemas.PROFILE))


def profiles_by_member(responses: DataFrame, key: str) -> DataFrame:
    """(key, profile, status); the profile may stand below a `results` key."""
    raw = unwrap(F.col("body"), "results")
    parsed = responses.withColumn("profile", _profile(raw))
    return parsed.select(key, "profile", _status(F.col("profile"), F.lit(True)).alias("status"))


def profiles_by_subject(responses: DataFrame, key: str) -> DataFrame:
    """(key, sub, profile, authorized, n_data, status) from subject responses; only the first entry of data counts."""
    body = F.col("body")
    first = F.get_json_object(body, "$.data[0]")
    data = F.get_json_object(body, "$.data")
    parsed = responses.select(
        key,
        "body",
        "failure",
        F.get_json_object(first, "$.sub").alias("sub"),
        _profile(F.get_json_object(first, "$.profile")).alias("profile"),
        F.coalesce(F.get_json_object(body, "$.meta.authorized").try_cast("boolean"), F.lit(False)).alias("authorized"),
        F.coalesce(F.json_array_length(data), F.lit(0)).alias("n_data"),
    )
    whole = F.when(F.json_array_length(F.get_json_object(F.col("body"), "$.data")).isNotNull(), F.lit(1))
    return parsed.select(key, "sub", "profile", "authorized", "n_data", _status(whole, (F.col("n_data") == 0) | F.col("profile").isNotNull()).alias("status"))


def with_fallback(by_subject: DataFrame, by_member: DataFrame, key: str) -> DataFrame:
    """(key, profile, status): a subject response without data falls back to the member's profile; an unauthorized one stops."""
    member = by_member.select(key, F.col("profile").alias("m_profile"), F.col("status").alias("m_status"))
    met = by_subject.join(member, key, "left")
    empty = (F.col("status") == "ok") & (F.col("n_data") == 0)
    stopped = (F.col("status") == "ok") & ~empty & ~F.col("authorized")
    profile = F.when(empty, F.col("m_profile")).when(~stopped, F.col("profile"))
    status = F.when(empty, F.coalesce("m_status", F.lit("not_found"))).when(stopped, "unauthorized").otherwise(F.col("status"))
    return met.select(key, profile.alias("profile"), status.alias("status"))


def group_metadata(responses: DataFrame, key: str = "group_id") -> DataFrame:
    """(group_id, raw, status); the metadata may stand below a `results` key."""
    raw = unwrap(F.col("body"), "results")
    keys = F.json_object_keys(raw)
    return responses.select(key, F.when(keys.isNotNull(), raw).alias("raw"), _status(keys, F.lit(True)).alias("status"))


def issued(tokens: DataFrame, nonces: DataFrame) -> DataFrame:
    """Tokens whose nonce was issued."""
    return tokens.join(nonces.select("nonce").distinct(), "nonce", "left_semi")


def logout_accepted(code: Column, body: Column, user_name: Column) -> Column:
    """Whether a logout notice was taken: a 2xx answer that echoes the user and says so."""
    echo = F.get_json_object(body, "$.data.user") == user_name
    said = F.lower(F.get_json_object(body, "$.message")).contains("successful")
    return F.coalesce(code.between(200, 299) & echo & said, F.lit(False))
