"""scriva: a PySpark engine that turns OCR text and text boxes into checked records."""
