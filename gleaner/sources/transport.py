"""One HTTP exchange, and the rules around it: retries, redirects, ceilings, policies and pacing.

A transport is a callable (url, agent) -> (status, headers, chunks of the body); it raises OSError
where the network fails. Tests and replays pass their own; ``urllib_transport`` uses the network.
"""

from __future__ import annotations

import hashlib
import importlib
import random
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import HTTPRedirectHandler, Request, build_opener
from urllib.robotparser import RobotFileParser

from gleaner.functions.urls import cleaned, resolved

Transport = Callable[[str, str], tuple[int, dict[str, str], Iterable[bytes]]]
BLOCK = 64 * 1024
RETRIED = frozenset({429, 500, 502, 503, 504})
REDIRECTS = frozenset({301, 302, 303, 307, 308})


class FetchError(Exception):
    """A failure with a fixed code and the stage (robots or resource) that it happened in."""

    def __init__(self, code: str, stage: str, message: str = "", status: int | None = None, wait: str | None = None) -> None:
        """``wait`` is the Retry-After header of the answer that ended it."""
        super().__init__(message or code)
        self.code, self.stage, self.status, self.wait = code, stage, status, wait


class _NoRedirect(HTTPRedirectHandler):
    def redirect_request(self, *args, **kwargs):
        return None


def urllib_transport(url: str, agent: str) -> tuple[int, dict[str, str], Iterable[bytes]]:
    request = Request(url, headers={"User-Agent": agent, "Accept-Encoding": "identity"})
    try:
        answer = build_opener(_NoRedirect).open(request, timeout=60)
    except HTTPError as error:
        answer = error
    return answer.status, {k.lower(): v for k, v in answer.headers.items()}, iter(lambda: answer.read(BLOCK), b"")


def load(name: str) -> Transport:
    """The transport named ``module:function``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def wait_seconds(raw: str | None, now: float) -> float | None:
    """Seconds that a Retry-After header asks for; None if it is absent or unreadable."""
    try:
        return max(0.0, float(raw))
    except (TypeError, ValueError):
        pass
    try:
        return max(0.0, parsedate_to_datetime(raw).timestamp() - now)
    except (TypeError, ValueError):
        return None


def retried(action: Callable[[], object], error: type[Exception], pauses: Iterable[float], sleep: Callable[[float], None] = time.sleep) -> object:
    """The action's result; after each error a pause, after the last pause the error counts."""
    for pause in pauses:
        try:
            return action()
        except error:
            sleep(pause)
    return action()


@dataclass
class Limits:
    """Ceilings of one client: bytes of a file, bytes of all files, tries, redirects, waits."""

    file_bytes: int = 100 << 20
    budget_bytes: int = 500 << 20
    policy_bytes: int = 1 << 20
    tries: int = 3
    redirects: int = 8
    policy_redirects: int = 6
    interval_s: float = 1.0
    longest_wait_s: float = 60.0
    retry_base_s: float = 1.0
    retry_429: bool = True


@dataclass
class Client:
    """Fetches the resources of one task's hosts, one after the other and spaced out."""

    agent: str
    transport: Transport = urllib_transport
    limits: Limits = field(default_factory=Limits)
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.time
    transferred: int = 0
    last: dict[str, float] = field(default_factory=dict)
    delays: dict[str, float] = field(default_factory=dict)
    policies: dict[str, RobotFileParser | FetchError | None] = field(default_factory=dict)
    bodies: dict[str, tuple[str, int, str]] = field(default_factory=dict)  # origin -> URL, status and text of a policy asked for

    def fetch(self, url: str) -> dict:
        """(url, content_type, charset, sha256, bytes, content) of a resource behind its redirects."""
        at, seen = cleaned(url), set()
        if at is None:
            raise FetchError("url_invalida", "resource")
        for _ in range(self.limits.redirects + 1):
            if at in seen:
                raise FetchError("redirect_loop", "resource")
            seen.add(at)
            self._check_policy(at)
            status, headers, body = self._transfer(at, self.limits.file_bytes, "resource")
            if status in REDIRECTS:
                at = resolved(at, headers.get("location", ""))
                if at is None:
                    raise FetchError("url_invalida", "resource")
                continue
            if status != 200:
                raise FetchError(f"http_{status}", "resource", status=status)
            kind, _, rest = headers.get("content-type", "").partition(";")
            charset = rest.partition("charset=")[2].split(";")[0].strip(' "') or "utf-8"
            return {"url": at, "content_type": kind.strip().lower(), "charset": charset, "sha256": hashlib.sha256(body).hexdigest(), "bytes": len(body), "content": body}
        raise FetchError("redirect_limite", "resource")

    def _transfer(self, url: str, ceiling: int, stage: str) -> tuple[int, dict[str, str], bytes]:
        """One answer after retries; waits as long as the server asks, up to the longest wait."""
        for attempt in range(self.limits.tries):
            last = attempt == self.limits.tries - 1
            try:
                status, headers, body = self._once(url, ceiling, stage)
            except OSError as error:
                if last:
                    raise FetchError("timeout" if isinstance(error, TimeoutError) else "erro_rede", stage, str(error)) from error
                status, headers = 0, {}
            if status and (status not in RETRIED or last or (status == 429 and not self.limits.retry_429)):
                return status, headers, body
            wait = wait_seconds(headers.get("retry-after"), self.clock()) or 0.0
            if wait > self.limits.longest_wait_s:
                raise FetchError("retry_after", stage, status=status, wait=headers.get("retry-after"))
            self.sleep(min(max(wait, self.limits.retry_base_s * 2.0**attempt + random.random()), self.limits.longest_wait_s))
        raise AssertionError

    def _once(self, url: str, ceiling: int, stage: str) -> tuple[int, dict[str, str], bytes]:
        if self.transferred >= self.limits.budget_bytes:
            raise FetchError("limite_execucao", stage)
        host = urlsplit(url).netloc
        wait = self.last.get(host, float("-inf")) + max(self.limits.interval_s, self.delays.get(host, 0)) - self.clock()
        if wait > self.limits.longest_wait_s:
            raise FetchError("espera_dominio", stage)
        if wait > 0:
            self.sleep(wait)
        self.last[host] = self.clock()
        status, headers, chunks = self.transport(url, self.agent)
        stated = int(headers["content-length"]) if headers.get("content-length", "").isdigit() else None
        if stated is not None and stated > ceiling:
            raise FetchError("limite_arquivo", stage)
        body = bytearray()
        for chunk in chunks:
            body += chunk
            self.transferred += len(chunk)
            if len(body) > ceiling:
                raise FetchError("limite_arquivo", stage)
            if self.transferred > self.limits.budget_bytes:
                raise FetchError("limite_execucao", stage)
        if stated is not None and len(body) < stated:
            raise FetchError("download_incompleto", stage)
        return status, headers, bytes(body)

    def _check_policy(self, url: str) -> None:
        p = urlsplit(url)
        origin = f"{p.scheme}://{p.netloc}"
        if origin not in self.policies:
            try:
                self.policies[origin] = self._policy(origin)
            except FetchError as error:
                self.policies[origin] = error  # not asked again by this client
        policy = self.policies[origin]
        if isinstance(policy, FetchError):
            raise policy
        if policy is not None and not policy.can_fetch(self.agent, url):
            raise FetchError("robots_bloqueado", "robots")

    def _policy(self, origin: str) -> RobotFileParser | None:
        """The origin's policy; None if it has none (404). A policy found behind redirects holds for its own origin, too."""
        at, seen = f"{origin}/robots.txt", set()
        while at not in seen and len(seen) < self.limits.policy_redirects:
            seen.add(at)
            status, headers, body = self._transfer(at, self.limits.policy_bytes, "robots")
            if status in REDIRECTS and headers.get("location"):
                at = resolved(at, headers["location"])
                if at is None:
                    break
                continue
            text = body.decode("utf-8", "replace")
            self.bodies[origin] = (at, status, text)
            p = urlsplit(at)
            policy = self.adopt(origin, status, text)
            if p.path == "/robots.txt":
                self.policies.setdefault(f"{p.scheme}://{p.netloc}", policy)
                self.delays.setdefault(p.netloc, self.delays.get(urlsplit(origin).netloc, 0.0))
            return policy
        raise FetchError("robots_indisponivel", "robots")

    def adopt(self, origin: str, status: int, text: str) -> RobotFileParser | None:
        """What a policy's answer means for an origin, and the pause that it asks for."""
        if status == 404:
            return None
        if status != 200 or "<html" in text.lower() or "<!doctype html" in text.lower():
            raise FetchError("robots_indisponivel", "robots", status=status)
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        rate = parser.request_rate(self.agent)
        each = rate.seconds / rate.requests if rate and rate.requests else 0.0
        self.delays[urlsplit(origin).netloc] = max(float(parser.crawl_delay(self.agent) or 0), each)
        return parser


def utc_now() -> datetime:
    return datetime.now(UTC)
