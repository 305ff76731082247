"""Hand-made dirty rows that meet each rule once."""

SALES = [
    ("S1", "C1", "P1", "2024-03-01", 2, 100.00, 5.0, " cash "),
    ("S2", "C1", "P1", "30/12/2024", 1, 50.00, 0.0, "CASH"),
    ("S2", "C2", "P1", "2024-03-02", 1, 50.00, None, None),
    ("S3", "C2", "P2", "20240520", 1, 10.00, 0.0, "CASH"),
    ("S4", "C2", "P2", "12-30-2024", 1, 10.00, 0.0, "CASH"),
    ("S5", "C1", "P2", "2024-03-03", 0, 10.00, 0.0, "CASH"),
    ("S6", "C1", "P2", "2024-03-03", 1, -10.00, 0.0, "CASH"),
    ("S7", None, "P2", "2024-03-03", 1, 10.00, 0.0, "CASH"),
    (None, "C1", "P2", "2024-03-03", 1, 10.00, 0.0, "CASH"),
    ("S8", "C1", "P1", "2024-03-04", 1, 999999.99, 0.0, "PAYPAL"),
    ("S9", "C9", "P1", "2024-03-04", 5, 100.00, 50.0, "PAYPAL"),
    ("S10", "C1", "P1", "2024-03-04", 1, 10.00, 20.0, "PAYPAL"),
]

CUSTOMER_COLUMNS = (
    "customer_code string, first_name string, last_name string, email string, phone string, "
    "country string, city string, registration_date string, customer_segment string"
)

CUSTOMERS = [
    ("C1", "  ALBA  ", "de la rosa", "Alba@Example.com", "(912) 345-6789", "peru", " lima ",
     "2023-01-05", " gold "),
    ("C2", "Béla", "Núñez", "béla@example.com", "+51-999-000001", "Peru", "Cusco",
     "05/01/2023", "silver"),
    ("C3", "Cy", "Dane", " cy@example.com ", None, None, None, "2023-02-01", None),
    ("C4", None, "Eck", "e@example.com", "1", None, None, "2023-02-01", "gold"),
]

PRODUCTS = [
    ("P1", "macBook pro", "Non-Fiction", "x", "acme", 100.0, 75.0, 1.0),
    ("P2", "desk", "home", "x", "acme", 0.0, 5.0, 1.0),
    ("P3", "lamp", "home", "x", "acme", 10.0, 12.0, 1.0),
    ("P4", "rug", "home", "x", "acme", 10.0, None, 1.0),
    ("P5", "pen", "home", "x", "acme", 10.0, 10.0, 0.0),
    ("P6", "cup", "home", "x", "acme", 10.0, 10.0, 0.1),
]
