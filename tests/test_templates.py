"""Chat templates given as text, against plain Python renderings."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.templates import TemplateError, render_template
from quarry.plans.queries import CHATML_TEMPLATE, HEADER_TEMPLATE, INST_TEMPLATE

MSG = "array<struct<role:string,content:string>>"
CHATS = [
    [("system", "Be kind."), ("user", " hi \n"), ("assistant", "hello")],
    [("user", "a 'quoted' \"text\" {{ x }} {% y %}"), ("assistant", " b "), ("user", "")],
    [("tool", None), (None, "x")],
    [],
]


def rendered(spark, template, **options):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CHATS)], f"i int, m {MSG}").coalesce(1)
    return [r.t for r in df.orderBy("i").select(render_template("m", template, **options).alias("t")).collect()]


def test_registered_templates(spark):
    chatml = [("" if not c or c[0][0] == "system" else "<|im_start|>system\nBe brief.<|im_end|>\n")
              + "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in c) for c in CHATS]
    assert rendered(spark, CHATML_TEMPLATE) == chatml
    assert rendered(spark, CHATML_TEMPLATE, generation_prompt=True) == [t + "<|im_start|>assistant\n" for t in chatml]

    def inst(r, t):
        t = t or ""
        return f"[INST] {t.strip()} [/INST]" if r == "user" else f" {t.strip()}</s>" if r == "assistant" else f"<<SYS>>\n{t}\n<</SYS>>\n\n"
    assert rendered(spark, INST_TEMPLATE, bos_token="<s>", eos_token="</s>") == ["<s>" + "".join(inst(*m) for m in c) for c in CHATS]

    def header(c):
        out = "<|begin|>" if c else ""
        for i, (r, t) in enumerate(c):
            out += f"<|start_header_id|>{r or ''}<|end_header_id|>\n\n"
            out += t.strip() + "<|eot_id|>" if t and i < len(c) - 1 else (t or "") + "<|end|>"
        return out
    assert rendered(spark, HEADER_TEMPLATE, bos_token="<|begin|>") == [header(c) for c in CHATS]


def test_conditions_comments_and_white_space(spark):
    t = ("{# a comment #}\n{% for m in messages %}\n  {% if not (m.role == 'user' or m.role == 'tool') and loop.index0 != 0 %}\nN{{ m['content'] }}\n"
         "  {% elif loop.last %}\nL\n  {% else %}\n-{% endif %}\n{% endfor %}\nend")
    assert rendered(spark, t) == ["--Nhello\nend", "-N b \nL\nend", "-N" + "x\n" + "end", "end"]
    assert rendered(spark, "{{ messages[0].role }}|{{- ' x ' }} y") == ["system| x  y", "user| x  y", "tool| x  y", "| x  y"]
    assert rendered(spark, "{% if messages %}some{% else %}none{% endif %}") == ["some", "some", "some", "none"]
    assert spark.range(1).select(render_template(F.lit(None).cast(MSG), "x").alias("t")).first().t is None


def test_raise_exception_only_where_reached(spark):
    t = "{% for m in messages %}{% if m.role == 'tool' %}{{ raise_exception('no tools') }}{% endif %}{% endfor %}ok"
    df = spark.createDataFrame([(c,) for c in CHATS[:2]], f"m {MSG}")
    assert [r.t for r in df.select(render_template("m", t).alias("t")).collect()] == ["ok", "ok"]
    with pytest.raises(Exception, match="no tools"):
        spark.createDataFrame([(CHATS[2],)], f"m {MSG}").select(render_template("m", t)).collect()


@pytest.mark.parametrize("bad", ["{% for m in tools %}{% endfor %}", "{{ message }}", "{% if x %}", "{{ messages | tojson }}", "{% set a = 1 %}",
                                 "{{ 'a' 'b' }}", "{% for m in messages %}{{ m.name }}{% endfor %}", "{{ messages }}"])
def test_what_is_not_understood_is_an_error(spark, bad):
    with pytest.raises(TemplateError):
        render_template("m", bad)
