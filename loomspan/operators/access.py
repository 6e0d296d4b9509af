"""What a scraped page gives access to, from its text and status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases of block pages and of login gates.
BLOCK = ("access denied", "forbidden", "captcha", "verify you are human", "cloudflare", "akamai", "edge suite", "security verification", "checking your browser")
LOGIN = ("log in", "sign in", "login", "create account", "subscribe", "register", "sign up")


def _any(text: Column, phrases: tuple[str, ...]) -> Column:
    return F.lower(F.coalesce(text, F.lit(""))).rlike("|".join(phrases))


def simple(text: Column) -> Column:
    return F.when(_any(text, BLOCK), "blocked").when(_any(text, LOGIN), "login-gated").otherwise("accessible")


def graded(text: Column, status: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    gate = F.when(F.length(t) > 5000, "partial").otherwise("login-gated")
    return F.when(status != 200, "error").when(t == "", "empty").when(_any(t, BLOCK), "blocked").when(_any(t, LOGIN), gate).when(F.length(t) > 1000, "accessible").otherwise("minimal")


def quality(text: Column, least: int) -> Column:
    return F.when(simple(text) == "blocked", "blocked").when(F.length(F.coalesce(text, F.lit(""))) < least, "low_content").otherwise("ok")


def confidence(text: Column, least: int) -> Column:
    n, q = F.length(F.coalesce(text, F.lit(""))), quality(text, least)
    return F.when(q == "blocked", 0.0).when(q == "low_content", 0.35).when(n >= 8000, 0.95).when(n >= 3000, 0.85).when(n >= least, 0.72).otherwise(0.4)
