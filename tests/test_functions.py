import hashlib
import uuid

from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import arrow, hashing, text

NAMESPACE = uuid.UUID(C.RECORD_NAMESPACE)


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


def test_furniture_goes_and_content_stays(spark):
    raw = "Eligibility\nShare this:\nFacebook\nLinkedIn\n12 shares\nsubscribe to our letters\nDeadline: 30 November 2026\n\n\n\n  Benefits  "
    assert one(spark, text.clean_text(F.col("t")), t=raw) == "Eligibility\nDeadline: 30 November 2026\n\nBenefits"


def test_words_split_at_unicode_blanks(spark):
    raw = "a b c d\x1ce \t f"
    assert one(spark, text.word_count(F.col("t")), t=raw) == len(raw.split())


def test_english(spark):
    english = "the students who apply for this programme must have a good deadline"
    assert one(spark, text.is_english(F.col("t")), t=english)
    assert not one(spark, text.is_english(F.col("t")), t="die Bewerber müssen einen Nachweis erbringen")
    assert one(spark, text.is_english(F.col("t")), t="123") is False


def test_titles(spark):
    assert one(spark, text.normalize_title(F.col("t")), t="Apply Now: MBA Fellowship") == "mba fellowship"
    assert one(spark, text.title_signals(F.col("t")), t="Postdoctoral award") == ["awards", "phd", "postdoc", "postdoc"]
    assert one(spark, text.title_signals(F.col("t")), t="Nothing") == ["no_signal"]
    assert one(spark, text.first_signal(F.col("t")), t="Postdoctoral award") == "phd"


def test_slugs_and_domains(spark):
    assert one(spark, text.slugify(F.col("t")), t="Türkiye Scholarships") == "turkiye_scholarships"
    assert one(spark, text.slugify(F.col("t")), t="–") == "unnamed"
    assert one(spark, text.domain_of(F.col("t")), t="https://WWW.Example.org:8080/a?b") == "example.org:8080"


def test_keys_equal_pythons(spark):
    url = "https://example.org/é?x=1"
    assert one(spark, hashing.record_id(F.col("t")), t=url) == str(uuid.uuid5(NAMESPACE, url))
    rank = int.from_bytes(hashlib.sha1(b"salt:abc").digest()[:8], "big")
    assert int(one(spark, hashing.stable_rank(F.col("t"), "salt"), t="abc")) == rank
    assert one(spark, hashing.content_hash(F.col("t")), t="  A\n b ") == hashlib.sha1(b"a b").hexdigest()


def test_strict_json():
    assert arrow.braces('x {"a": 1} y') == '{"a": 1}'
    assert arrow.braces('{"a": 1} and {"b": 2}') is None
    assert arrow.braces("none") is None and arrow.braces(None) is None
    assert arrow.braces('{"a": 1, "a": 2}') == '{"a": 2}'


def test_html_text():
    page = "<div>A<script>var t='</p>';</script><p>b  c<br>d</p><ul><li>1<li>2</ul></div>tail &amp; end"
    assert arrow.html_text(page) == "Ab c\nd\n1\n2\n\ntail & end"
    assert arrow.html_text("a &lt; b ") == "a < b" and arrow.html_text(None) == ""


def test_rouge_and_ratio():
    assert arrow.rouge_f1("a b c d", "a c d e") == 2 * 3 / 8
    assert arrow.rouge_f1("", "a") == 0.0 and arrow.rouge_f1(None, None) == 0.0
    assert arrow.ratio("tide", "diet") == 0.25 and arrow.ratio("diet", "tide") == 0.5


def test_section_compliance(spark):
    assert one(spark, text.section_compliance(F.col("t")), t="Deadline - mandatory funding summary") == 1.0
    assert one(spark, text.section_compliance(F.col("t")), t="Deadline") == 1 / 6
    assert one(spark, text.section_compliance(F.col("t")), t=" ") == 0.0
