"""DataFrame -> DataFrame operators.

calendar   W1 calendar index, W3 enrichment, D4 availability shift
grid       J1 base grid, P6 date window
joins      J2/J3 equi joins, J4/J5 as-of joins, P5 lineage names, J6 gold join
slices     hot keys of an ordered scan, cut by their rows (J4, W4)
panel      J10 panel assembly
gold       fused J10 + W2 + J6 (one shuffle of the grid)
labels     W2 forward values, F1/F2 labels, A6 last-wins dedupe
normalise  P1-P4, P11, P12, U1, source key maps
treat      D1-D5, W4
export     F3-F7 records
audit      A1-A4, A7, A8, J9 reports
quantiles  exact quantiles digit by digit
manifest   M1-M3, F9-F11, J7, U2
"""
