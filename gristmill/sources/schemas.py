"""Explicit input schemas. Reading with them avoids the extra pass of inference."""

from __future__ import annotations

# Column names and types of the supported input files.
ORDER_LINES = "OrderID STRING, Product STRING, Category STRING, Quantity INT, Price INT, City STRING"

RATINGS = "userId INT, movieId INT, rating DOUBLE"

PRICES = "Timestamp DATE, Stock STRING, Price DOUBLE"

POSTS = "Hashtag STRING, Date DATE, Region STRING, Platform STRING"

CUSTOMERS = (
    "customer_id STRING, total_spend DOUBLE, purchase_count INT, avg_basket_size DOUBLE, "
    "days_since_last_purchase INT, product_category_preference INT"
)

MESSAGES = "label STRING, message_text STRING"

# Dates stay text here: unreadable ones are counted before they are dropped.
RETAIL_ORDERS = (
    "`Order ID` STRING, `Order Date` STRING, `Ship Date` STRING, `Customer ID` STRING, "
    "`Customer Name` STRING, `Segment` STRING, `Country` STRING, `City` STRING, `State` STRING, "
    "`Postal Code` INT, `Region` STRING, `Product ID` STRING, `Category` STRING, "
    "`Sub-Category` STRING, `Product Name` STRING, `Sales` DOUBLE, `Quantity` INT, "
    "`Discount` DOUBLE, `Profit` DOUBLE"
)

ORDER_DOCUMENTS = (
    "order_id STRING, customer STRING, category STRING, product STRING, "
    "quantity INT, price INT, city STRING, status STRING"
)

YEAR_READINGS = "year INT, temperature INT"
