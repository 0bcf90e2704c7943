"""The steps the reports and conversions are made of."""
