"""rowsmith: text, money, calendar and catalogue analytics as Spark DataFrame operators."""
