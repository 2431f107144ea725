"""Conversational seed phrases: (seed_no, w1, pos, w2); the order of the successors is their rank."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "seed_no int, w1 string, pos int, w2 string"

#: The Bengali seeds, an antecedent and its successors in order.
BENGALI = """
আমি: তোমাকে এখন করব যাব ভালো মনে আছি
তুমি: কেমন কোথায় কি কখন যাবে করছ আছো
আপনি: কেমন কোথায় কি কখন যাবেন করছেন আছেন
কেমন: আছো আছেন হলো লাগল কাটল
শুভ: সকাল রাত্রি জন্মদিন কামনা সন্ধ্যা কামনা
অনেক: ধন্যবাদ সুন্দর ভালো কষ্ট ভালোবাসা দিন
খুব: ভালো সুন্দর সুন্দর কষ্ট খুশি
ধন্যবাদ: ভাই আপনাকে তোমাকে অনেক প্রিয়
বাসায়: যাব পৌঁছে আছি এসো যাও
খাবার: খেয়েছ খাব দাও খাই
কি: খবর করছ করছেন হয়েছে অবস্থা
কোথায়: আছো আছেন যাবে যাবেন
ইনশাআল্লাহ: ভালো হবে যাব দেখা
মাশাল্লাহ: অনেক সুন্দর ভালো
আলহামদুলিল্লাহ: ভালো আছি সব
দেখা: হবে করব করবেন হলে
কথা: বলব বলবেন হবে আছে
ভালো: থাকবেন থাকো লাগল হয়েছে
কখন: আসবে আসবেন যাবে হবে
আজ: সারাদিন বৃষ্টি রাতে সকালে
কাল: দেখা হবে যাব আসবে
কাজ: শেষ করছি করব আছে
টাকা: দাও পাঠাও আছে দিয়েছি
নাম্বার: দাও দিন পাঠাও
ফোন: দিচ্ছি দাও করব ধরো
মেসেজ: দাও করব দিয়েছি পেয়েছি
"""

#: The English seeds, a plain text file beside this module.
ENGLISH = (Path(__file__).parent / "seeds_en.txt").read_text()


def parse(lines: str) -> list[tuple[int, str, int, str]]:
    pairs = [line.split(":", 1) for line in lines.splitlines() if line.strip() and not line.startswith("#")]
    return [(k, w1.strip(), pos, w2) for k, (w1, rest) in enumerate(pairs) for pos, w2 in enumerate(rest.split())]


def inline(spark: SparkSession, lines: str) -> DataFrame:
    return spark.createDataFrame(parse(lines), SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Seeds from a file of `w1: w2 w2 ...` lines; its order is the rank. Seed lists are short: at most 100,000 lines are taken, more raise."""
    rows = spark.read.text(path, wholetext=True).collect()
    lines = "\n".join(r["value"] for r in rows)
    if lines.count("\n") > 100_000:
        raise ValueError("a seed list is a hand-made table, not a corpus")
    return inline(spark, lines)
