"""Table definitions: the star, its KPI tables and the reporting views over them."""
