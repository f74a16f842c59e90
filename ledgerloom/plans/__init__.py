"""The work itself: vendor quality and master data, the star schema, the three-way match and its reports."""
