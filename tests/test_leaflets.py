from pricelode.operators.leaflets import joined_lines, page_lines, page_products, parse_pages, parse_products, title_line
from pyspark.sql import functions as F

PAGE = "Víkendový tip\n\n• op. 500 g, různé\n129,90 Kč\r\n250 g = 39,90 Kč\nMáslo\n4,5 €\ntext s 5 Kč uvnitř"


def test_page_lines():
    assert page_lines(PAGE) == [(3, "item", "op. 500 g, různé", None), (4, "price", "Víkendový tip", 129.9), (5, "unit", "250 g", 39.9), (7, "price", "Máslo", 4.5)]
    assert page_lines(None) == page_lines("") == []


def test_pages(spark):
    rows = parse_pages(spark.createDataFrame([(1, PAGE, "k"), (2, None, "k")], "id int, t string, kind string"), "id", F.col("t")).collect()
    assert [(r.id, r.kind) for r in rows] == [(1, "item"), (1, "price"), (1, "unit"), (1, "price")]


def test_whole_subject():
    title = "Čerstvý chléb " * 30 + "konec"
    assert page_lines(title + "\n39,90 Kč") == [(2, "price", title, 39.9)]


ROWS = """AKČNÍ NABÍDKA
Čerstvé máslo
z farmy
Kuřecí prsa
• balení 250 g • 4 x 125 g
- 20 %
199,90/
129
90
1 kg = 519,60 Kč
bez Aplikace / 400 Kč Aplikace
3490
Vejce čerstvá
10 ks = 55,00 Kč
159,-
více druhů"""


def test_page_products():
    a, b, c = page_products(ROWS)
    assert (a.title, a.pack_quantity, a.pack_unit, a.price, a.old_price, a.discount_pct, a.per_kg, a.per_kg_club) == ("Čerstvé máslo z farmy", 250, "g", 129.9, 199.9, 20, 519.6, 400)
    assert (b.title, b.pack_quantity, b.price, b.old_price) == ("Kuřecí prsa", 500, 34.9, None)
    assert (c.title, round(c.per_kg, 6), c.price) == ("Vejce čerstvá", 100, 159)
    assert page_products(None) == page_products("129,90 Kč") == []
    assert joined_lines(["a • b • c", "1 kg", "= 5 Kč"]) == ["a", "• b", "• c", "1 kg = 5 Kč"]
    assert not title_line("Máslo 5,00 Kč") and not title_line("SUPER SLEVA") and title_line("Máslo 82 g")


def test_products_of_pages(spark):
    rows = parse_products(spark.createDataFrame([(1, ROWS, "k"), (2, None, "k")], "id int, t string, title string"), "id", F.col("t")).collect()
    assert [(r.id, r.product_no, r.title, r.price) for r in rows] == [(1, 1, "Čerstvé máslo z farmy", 129.9), (1, 2, "Kuřecí prsa", 34.9), (1, 3, "Vejce čerstvá", 159.0)]
