import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rosterlift.functions import contact, text

LIMITS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = st.lists(st.text(alphabet=st.sampled_from("ab0+@./- :wW<>&;\té\n"), max_size=14), min_size=30, max_size=80)


def _stable(values, make, texts):
    once = values(make, texts)
    assert values(make, once) == once


@LIMITS
@given(TEXTS)
def test_email_norm_is_idempotent(values, texts):
    _stable(values, contact.email_norm, texts)


@LIMITS
@given(TEXTS)
def test_phone_norm_leaves_digits_after_one_optional_plus(values, texts):
    for out in values(contact.phone_norm, texts):
        assert out is None or re.fullmatch(r"\+[0-9]*|[0-9]+", out)


@LIMITS
@given(TEXTS)
def test_clean_html_leaves_one_trimmed_line(values, texts):
    for out in values(text.clean_html, texts):
        assert "\n" not in out and "  " not in out and out == out.strip(" ")


@LIMITS
@given(TEXTS)
def test_scrub_is_idempotent(values, texts):
    _stable(values, text.scrub, texts)
