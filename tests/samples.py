"""Hand-made inputs, written into a temporary folder by the tests."""

FIXED_LAYOUT = """claims_2016 (6 Rows)
Columns in File: 5

Order Field Long    Field Short SAS  Start Field
      Name          Name        Type       Width
----- ------------- ----------- ---- ----- -----
1     Person id     BENE_ID     CHAR 1     5
2     State         STATE_CD    CHAR 6     2
3     Paid amount   PMT_AMT     NUM  8     8
4     Service date  SRVC_DT     DATE 16    8
5     Remark        REMARK      CHAR 24    6

-- End of File Transfer Summary
"""

DELIMITED_LAYOUT = """Data File: visits_ak_ip_2007.csv  Rows:      3  Size(Bytes): 60
Data File: visits_co_ip_2007.csv  Rows: 12,840  Size(Bytes): 1

Order Column      SAS      Description
      Name        Type
----- ----------- -------- -------------
1     BENE_ID     CHAR     Person id
2     PMT_AMT     NUM      Paid
3     SRVC_DT     DATE     Service

Note: values are synthetic
"""

FIXED_RECORDS = (
    b"A0001MA   12.5020160105ok    \n"
    b"A0002       1e5              \n"
    b"\xc3\xa9001RI0000000720161231last \r\n"
    b"A0004CT     -.520160229a\xffb   \n"
    b"A0005NH    -0.519600505\tx    \n"
    b"A0005NH    -0.519600505\tx    \n"
)

CSV_TEXT = b'A1,12.5,20070101\n"x ""q"", y", 7 ,\n\nNA,.5,20071231\n'
