"""Deterministic offline responders.

They stand in for the hosted model in tests, benches and offline runs. Each
reply depends on the MD5 of the whole prompt, so a wrong character anywhere in a
rendered prompt shows in the result, and SQL can recompute it. A real deployment
passes its own factory to :func:`quire.operators.infer.infer`.
"""

from __future__ import annotations

import json

from quire.functions.replies import OPTION_LETTERS


def prompt_digest(prompt: str) -> str:
    import hashlib

    return hashlib.md5((prompt or "").encode("utf-8")).hexdigest()


class CandidateResponder:
    """Step 1 of the two-step answer: ``n`` candidate lines ``'<i>. <letter>'``;
    line i carries the letter of the digest's character i."""

    def __init__(self, n: int = 4):
        self.n = n

    def __call__(self):
        n = self.n

        def respond(prompt: str) -> str:
            d = prompt_digest(prompt)
            return "\n".join(f"{i + 1}. {OPTION_LETTERS[ord(d[i % 32]) % 5]}" for i in range(n))

        return respond


class ContextResponder:
    """Context extraction: a JSON object whose context repeats the digest; with
    ``fail_mod`` the reply is broken text for some prompts (a model that
    sometimes ignores the format)."""

    def __init__(self, fail_mod: int | None = None):
        self.fail_mod = fail_mod

    def __call__(self):
        fail_mod = self.fail_mod

        def respond(prompt: str) -> str:
            d = prompt_digest(prompt)
            if fail_mod and ord(d[0]) % fail_mod == 0:
                return "Sorry, I cannot tell."
            return json.dumps({"context": "seen " + " ".join([d] * 6),
                               "is_contextual": ord(d[1]) % 2 == 0,
                               "explanation": f"len {len(prompt)}"})

        return respond


class VerdictResponder:
    """Fact check: a JSON verdict, or plain text for some prompts."""

    def __call__(self):
        def respond(prompt: str) -> str:
            d = prompt_digest(prompt)
            if ord(d[0]) % 5 == 0:
                return " I think so. "
            return json.dumps({"is_supported": ord(d[1]) % 2 == 0, "explanation": f"checked {d}"})

        return respond


class RewriteResponder:
    """Question rewrite, by the digest: a prefixed, quoted rewrite; the question
    lower-cased (an unchanged rewrite); or nothing."""

    def __init__(self, start_marker: str, end_marker: str):
        self.start_marker = start_marker
        self.end_marker = end_marker

    def __call__(self):
        start, end = self.start_marker, self.end_marker

        def respond(prompt: str) -> str:
            question = prompt.split(start, 1)[1].split(end, 1)[0]
            d = prompt_digest(prompt)
            k = ord(d[0]) % 3
            if k == 0:
                return f'Rewritten question: "{question} (in the clip {d[:8]})"'
            if k == 1:
                return question.lower()
            return ""

        return respond


class PickCandidateResponder:
    """Step 2 of the two-step answer: of the candidate lines of the aggregation
    prompt that carry an option letter, the one the digest points at."""

    def __call__(self):
        import re

        pattern = re.compile(r"^\s*\d+[.)]\s*\(?([A-E])\b", re.MULTILINE)

        def respond(prompt: str) -> str:
            found = pattern.findall(prompt)
            return found[ord(prompt_digest(prompt)[0]) % len(found)] if found else ""

        return respond


class LetterResponder:
    """One option letter per prompt, chosen from the first character of its
    digest (so different passes of a question can disagree)."""

    def __call__(self):
        def respond(prompt: str) -> str:
            return OPTION_LETTERS[ord(prompt_digest(prompt)[0]) % 5]

        return respond


class FailingResponder:
    """``inner``, but the call fails for good where character 2 of the digest is
    a multiple of ``mod``."""

    def __init__(self, inner, mod: int = 4, message: str = "403 permission denied"):
        self.inner, self.mod, self.message = inner, mod, message

    def __call__(self):
        inner, mod, message = self.inner(), self.mod, self.message

        def respond(prompt: str) -> str:
            if ord(prompt_digest(prompt)[2]) % mod == 0:
                raise RuntimeError(message)
            return inner(prompt)

        return respond


class FlakyResponder:
    """``inner``, but the first call for a prompt whose digest starts with an
    even character fails with a message that is worth a retry."""

    def __init__(self, inner, message: str = "529 overloaded"):
        self.inner, self.message = inner, message

    def __call__(self):
        inner, message, seen = self.inner(), self.message, set()

        def respond(prompt: str) -> str:
            d = prompt_digest(prompt)
            if ord(d[0]) % 2 == 0 and d not in seen:
                seen.add(d)
                raise RuntimeError(message)
            return inner(prompt)

        return respond


class MediaResponder:
    """Replies with the media it was given: the local file if there is one, else
    the address."""

    def __call__(self):
        def respond(prompt: str, row: dict) -> str:
            return f"{row['media_path'] or row['url']}: {prompt_digest(prompt)[:8]}"

        return respond


class GoesDown:
    """A model that cannot go on once ``when(prompt)`` holds: from then on its
    task fails (see :class:`quire.operators.calls.ModelDown`)."""

    MESSAGE = "the model is down"

    def __init__(self, inner, when):
        self.inner, self.when = inner, when

    def __call__(self):
        from quire.operators.calls import ModelDown

        respond, when, message = self.inner(), self.when, self.MESSAGE

        def answer(prompt: str) -> str:
            if when(prompt):
                raise ModelDown(message)
            return respond(prompt)

        return answer
