"""Plain versions of what the operators share."""

import hashlib
import re


def words(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
