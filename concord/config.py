"""Settings of a reconciliation, with defaults for all of them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    """provider is the remote service's name as it appears in role names, prefixed user names and notices."""

    provider: str = "provider"
    aliases: tuple[str, ...] = ("broker",)
    #: Fields of a stored profile: the user's name at the remote service, and where a replaced e-mail is kept.
    member_field: str = "identifier_kc_username"
    old_email_field: str = "identifier_email"
    # Fixed values down to backoff_step: what a notice may say, administration roles and the default times.
    allowed_events: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"users": ("created", "updated", "deleted"), "groups": ("created", "updated", "deleted"), "associations": ("associated",)}
    )
    superadmin_roles: tuple[str, ...] = ("administration", "administration-moderation")
    throttle_seconds: int = 60
    lock_attempts: int = 10
    backoff_initial: float = 1.0
    backoff_step: float = 1.0
    cookie_ttl_seconds: int = 300
    allowed_hosts: tuple[str, ...] = ()
    excluded_prefixes: tuple[str, ...] = ("/api/", "/static/", "/sso/broker-callback/")
    excluded_mount: str = "/api"
    callback_suffix: str = "/sso/broker-callback"
